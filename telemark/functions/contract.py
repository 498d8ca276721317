"""The data contract: which columns a daily file may have, how each is read, and what makes a day bad."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date

CORE = ("date", "serial_number", "failure")


@dataclass(frozen=True)
class Rule:
    """How one column is read. ``low``: below is impossible. ``expected``: outside is kept with a warning."""

    name: str
    kind: str
    required: bool = False
    since: date = date.min
    warn_if_blank: bool = False
    low: int | None = None
    expected: tuple[int, int] | None = None


# The numbers in the two classes below.
@dataclass(frozen=True)
class Baseline:
    """A day is compared with the median of the last ``window`` normal days."""

    window: int = 7
    partial_below: float = 0.95
    warn_beyond: float = 0.03


@dataclass(frozen=True)
class Limits:
    """What blocks a day when it is exceeded."""

    quarantined_share: float = 0.005
    conflicting_devices: int = 50


# What is said of headers.
NEW_COLUMN = "new column not matching the counter pattern"
REQUIRED_GONE = "required column missing"
OPTIONAL_GONE = "optional column missing that existed on an earlier date"


@dataclass(frozen=True)
class Contract:
    version: str
    rules: tuple[Rule, ...]
    counter_pattern: str
    counter_kinds: dict[str, str]
    date_formats: tuple[dict, ...]
    include_pattern: str
    exclude_paths: tuple[str, ...]
    first_date: date
    baseline: Baseline = Baseline()
    limits: Limits = Limits()
    defects: dict[date, str] = field(default_factory=dict)

    def counter_kind(self, column: str) -> str | None:
        found = re.match(self.counter_pattern, column)
        return self.counter_kinds[found.group(2)] if found else None

    def specs(self, columns: list[str]) -> dict[str, Rule]:
        """The rule of each column of a layout; unknown columns have none and are not read."""
        by_name = {r.name: r for r in self.rules}
        found = {c: by_name.get(c) or ((kind := self.counter_kind(c)) and Rule(c, kind)) for c in columns}
        return {c: r for c, r in found.items() if r}

    def drift(self, columns: list[str], day: date) -> tuple[list[str], list[str]]:
        """(blocks, warnings) of a header: unknown columns and missing required ones block; missing optional ones that exist by that day warn."""
        known = self.specs(columns)
        unknown = [c for c in columns if c not in known]
        absent = [r for r in self.rules if r.name not in known and (r.required or r.since <= day)]
        blocks = [f"{NEW_COLUMN}: {c}" for c in unknown] + [f"{REQUIRED_GONE}: {r.name}" for r in absent if r.required]
        return blocks, [f"{OPTIONAL_GONE}: {r.name}" for r in absent if not r.required]


# Names, types, dates, formats and limits of the telemetry format.
START = date(2013, 4, 10)
DEFAULT = Contract(
    version="1.3.0",
    rules=(
        Rule("date", "date", True, START),
        Rule("serial_number", "string", True, START),
        Rule("model", "string", True, START, warn_if_blank=True),
        Rule("capacity_bytes", "bigint", True, START, warn_if_blank=True, low=1),
        Rule("failure", "boolean", True, START),
        Rule("vault_id", "integer", False, date(2023, 4, 1)),
        Rule("pod_id", "integer", False, date(2023, 4, 1), expected=(0, 19)),
        Rule("is_legacy_format", "boolean", False, date(2023, 4, 1)),
        Rule("datacenter", "string", False, date(2023, 7, 1), warn_if_blank=True),
        Rule("cluster_id", "integer", False, date(2023, 7, 1)),
        Rule("pod_slot_num", "integer", False, date(2023, 7, 1), expected=(0, 59)),
    ),
    counter_pattern=r"^smart_(\d+)_(normalized|raw)$",
    counter_kinds={"normalized": "integer", "raw": "bigint"},
    date_formats=({"pattern": "yyyy-MM-dd", "looks_like": r"^\d{4}-\d{2}-\d{2}$"}, {"pattern": "M/d/yy", "looks_like": r"^\d{1,2}/\d{1,2}/\d{2}$"}),
    include_pattern=r"(?:^|/)(\d{4}-\d{2}-\d{2})\.csv$",
    exclude_paths=("__MACOSX/",),
    first_date=START,
    defects={date(2022, 12, 10): "copy of 2022-12-11 (the real 2022-12-10 readings are not in the release)"},
)
