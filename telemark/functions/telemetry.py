"""Expressions of the telemetry domain. All stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TERABYTE = 1_000_000_000_000
#: More power-on hours than twenty years hold are not believed.
MAX_HOURS = 175_200


def year_quarter(day: Column) -> Column:
    """2019-06-17 -> '2019-Q2'."""
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def afr_pct(failures: Column, device_days: Column) -> Column:
    """Annualised failure rate in per cent; null without device days."""
    years = F.nullif(device_days, F.lit(0)).cast("double") / F.lit(365.0)
    return F.round(failures.cast("double") / years * 100, 2)


def is_boot(capacity_bytes: Column) -> Column:
    """Under a terabyte; unknown capacity counts as a data device."""
    return F.coalesce(capacity_bytes < TERABYTE, F.lit(False))


def age_days(hours: Column) -> Column:
    """Whole days of power-on time, or null where the hours can't be true."""
    return F.when(hours.between(0, MAX_HOURS), F.floor(hours / 24).cast("bigint"))


def any_positive(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(0)) > 0 for c in columns])


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def blank_to_null(text: Column) -> Column:
    bare = F.trim(text)
    return F.when(bare != "", bare)


def whole_number(text: Column, kind: str) -> Column:
    """Digits only, with a sign or not; scientific notation and overflow give null."""
    return F.when(text.rlike("^-?[0-9]+$"), text.try_cast(kind))


def parse_day(text: Column, formats: list[dict]) -> Column:
    """The first of the accepted formats whose look fits; an impossible date gives null."""
    tried = [F.when(text.rlike(f["looks_like"]), F.try_to_date(text, f["pattern"])) for f in formats]
    return F.coalesce(*tried)


def layout_fingerprint(columns: Column) -> Column:
    """Twelve hex digits that name an exact ordered header."""
    return F.substring(F.sha2(F.concat_ws(",", columns), 256), 1, 12)
