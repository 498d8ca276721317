"""Calendar quarters as values: an ordered number that knows its days and its archive."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta

# How quarters and archives are spelled.
_SPELLED = re.compile(r"Q(?P<number>[1-4])_(?P<year>[0-9]{4})", re.IGNORECASE)
_ARCHIVE = re.compile(r"data_(?:Q(?P<number>[1-4])_)?(?P<year>[0-9]{4})\.zip")


@dataclass(frozen=True, order=True)
class Quarter:
    """Quarters since the year 0: going on is addition, and order is time."""

    count: int

    @classmethod
    def of(cls, year: int, number: int) -> Quarter:
        return cls(4 * year + number - 1)

    @classmethod
    def containing(cls, day: date) -> Quarter:
        return cls.of(day.year, 1 + (day.month - 1) // 3)

    @classmethod
    def spelled(cls, text: str) -> Quarter:
        """The quarter that ``str`` writes as this text; case doesn't matter."""
        if (found := _SPELLED.fullmatch(text)) is None:
            raise ValueError(f"{text!r} is no quarter such as Q3_2025")
        return cls.of(int(found["year"]), int(found["number"]))

    def __add__(self, quarters: int) -> Quarter:
        return Quarter(self.count + quarters)

    def __str__(self) -> str:
        return f"Q{self.count % 4 + 1}_{self.count // 4:04}"

    @property
    def first(self) -> date:
        return date(self.count // 4, self.count % 4 * 3 + 1, 1)

    @property
    def last(self) -> date:
        return (self + 1).first - timedelta(days=1)

    @property
    def archive(self) -> str:
        return f"data_{self}.zip"


def archive_span(name: str) -> tuple[date, date] | None:
    """First and last day that an archive of this name is for: a quarter or a year; None for another name."""
    if (found := _ARCHIVE.fullmatch(name)) is None:
        return None
    year, number = int(found["year"]), found["number"]
    ends = (number, number) if number else (1, 4)
    return Quarter.of(year, int(ends[0])).first, Quarter.of(year, int(ends[1])).last


def archive_days(name: str, since: date) -> set[date] | None:
    """The days that an archive of this name should hold, none before ``since``; None for another name."""
    if (span := archive_span(name)) is None:
        return None
    start = max(span[0], since).toordinal()
    return set(map(date.fromordinal, range(start, span[1].toordinal() + 1)))
