"""Relational operators that the models and the profiling queries compose."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_between(rows: DataFrame, key: str, day: str, value: str, far: int, near: int) -> DataFrame:
    """As-of look-back: each row with the latest reading ``far`` to ``near`` days before, from one sort by key and day."""
    by_day = Window.partitionBy(key).orderBy(F.unix_date(day))
    # Of rows of one day, whose look-backs are the same, the first is kept: by the sort that is there, not by a table of all rows.
    first = (F.row_number().over(by_day) == 1) | ~F.lag(day).over(by_day).eqNullSafe(F.col(day))
    seen = rows.select(key, day, F.last(value).over(by_day.rangeBetween(-far, -near)).alias("past_value"), first.alias("_first"))
    return seen.filter("_first").drop("_first")


def latest_by_bucket(rows: DataFrame, key: str, day: str, value: str, far: int, near: int) -> DataFrame:
    """The same by an equi-join: a look-back touches two buckets of its own length at most, so a row meets the rows of those only."""
    width, at = far - near + 1, F.unix_date(day)
    past = rows.select(F.col(key).alias("_k"), at.alias("_d"), F.col(value).alias("_v"), F.floor(at / width).alias("_b"))
    ends = [F.floor((at - far) / width), F.floor((at - near) / width)]
    asked = rows.select(key, day, F.explode(F.array_distinct(F.array(*ends))).alias("_a"))
    inside = F.col("_d").between(F.unix_date(day) - far, F.unix_date(day) - near)
    met = asked.join(past, (F.col(key) == F.col("_k")) & (F.col("_a") == F.col("_b")) & inside, "left")
    return met.groupBy(key, day).agg(F.max_by("_v", "_d").alias("past_value"))


def previous_day(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Left self-join with the day before; null where the device didn't report then."""
    before = rows.select(key, F.date_add("date", 1).alias("date"), F.col(value).alias("previous"))
    return rows.select(key, "date", value).join(before, [key, "date"], "left")


def seen_after(events: DataFrame, rows: DataFrame, key: str, since: str) -> DataFrame:
    """One row: how many keys have an event, and how many of them appear on a later day."""
    again = events.join(rows.select(key, "date"), key).filter(F.col("date") > F.col(since)).agg(F.count_distinct(key).alias("seen_again"))
    return events.agg(F.count("*").alias("with_event")).crossJoin(F.broadcast(again))  # one row each


def unstable(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """How many keys have more than one value of each column: those whose least and greatest differ.

    A row per key of fixed width is all that is kept, not each value of each column. Texts and nested values
    are compared by 128 bits over them, as rows of other widths could only be aggregated by sorting.
    """
    plain = T.NumericType | T.BooleanType | T.DateType | T.TimestampType | T.TimestampNTZType
    shown = {c: [F.col(c)] if isinstance(rows.schema[c].dataType, plain) else [F.when(F.col(c).isNotNull(), h) for h in (F.xxhash64(c), F.xxhash64(F.lit(1), c))] for c in columns}
    each = rows.groupBy(key).agg(*(F.struct(F.min(v), F.max(v)).alias(f"{c}_{i}") for c, values in shown.items() for i, v in enumerate(values)))
    differ = {c: reduce(lambda a, b: a | b, (F.col(f"{c}_{i}.col1") != F.col(f"{c}_{i}.col2") for i in range(len(values)))) for c, values in shown.items()}
    return each.agg(*(F.count_if(d).alias(f"changing_{c}") for c, d in differ.items()))


def null_profile(rows: DataFrame) -> DataFrame:
    """A row per column: rows, nulls and distinct values, from one scan."""
    totals = rows.agg(F.count("*").alias("rows"), *(F.count(c).alias(f"n_{c}") for c in rows.columns), *(F.approx_count_distinct(c, 0.02).alias(f"d_{c}") for c in rows.columns))
    parts = F.array(*(F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"n_{c}")).alias("nulls"), F.col(f"d_{c}").alias("about_distinct")) for c in rows.columns))
    return totals.select("rows", F.explode(parts).alias("x")).select("x.column", "rows", "x.nulls", "x.about_distinct")


def percent_change(series: DataFrame, value: str) -> DataFrame:
    """Change against the day before it in the series (a row per day, so one partition holds it)."""
    before = F.lag(value).over(Window.orderBy("date"))
    return series.select("date", value, F.round((F.col(value) - before) / before * 100, 6).alias("change_pct"))


def top(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """Sorted head without a full sort: each task keeps k rows."""
    return rows.orderBy(*order).limit(k)


def except_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose (non-null) key is not among ``keys``."""
    return rows.join(keys.select(key).distinct(), key, "left_anti")
