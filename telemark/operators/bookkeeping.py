"""Histories of sources, days and layouts: which version is current, what replaced it, what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def layout_diff(layouts: DataFrame) -> DataFrame:
    """(fingerprint, first_day, columns) to what each layout adds and removes against the one before it."""
    w = Window.orderBy("first_day", "fingerprint")  # a handful of layouts in a history
    before = F.lag("columns").over(w)
    nothing = F.expr("cast(array() as array<string>)")
    return layouts.select(
        "fingerprint", "first_day", F.size("columns").alias("column_count"),
        F.when(before.isNull(), nothing).otherwise(F.array_except("columns", before)).alias("added"),
        F.when(before.isNull(), nothing).otherwise(F.array_except(before, "columns")).alias("removed"),
    )


def layouts_used(days: DataFrame, headers: DataFrame) -> DataFrame:
    """Current (date, fingerprint) days and (fingerprint, columns) to one row per layout, oldest first, with its differences."""
    used = days.groupBy("fingerprint").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("days"))
    whole = used.join(headers, "fingerprint")
    return whole.drop("columns").join(layout_diff(whole.select("fingerprint", "first_day", "columns")).drop("first_day"), "fingerprint").join(headers, "fingerprint")


def superseded(versions: DataFrame) -> DataFrame:
    """(source, sha, stored_at, is_current) with superseded_by: the next later version, else the current one; null for the current."""
    by_source = Window.partitionBy("source")
    in_order = by_source.orderBy("stored_at", "sha")
    current = F.max(F.when(F.col("is_current"), F.col("sha"))).over(by_source)
    # Versions stored in the same second are not later than each other.
    later = F.first("sha").over(by_source.orderBy("stored_second").rangeBetween(1, Window.unboundedFollowing))
    seconds = versions.withColumn("stored_second", F.unix_timestamp("stored_at")).withColumn("_n", F.row_number().over(in_order))
    return seconds.withColumn("superseded_by", F.when(~F.col("is_current"), F.coalesce(later, current))).drop("_n", "stored_second")


def day_changes(days: DataFrame, versions: DataFrame) -> DataFrame:
    """Current days as new, same or changed against the latest extracted version before."""
    older = versions.filter(~F.col("is_current") & F.col("extracted"))
    before = older.groupBy("source").agg(F.max_by("sha", F.struct("stored_at", "sha")).alias("sha"))
    previous = days.join(before, ["source", "sha"], "left_semi").select("source", "date", F.col("day_sha").alias("previous_sha"))
    current = days.join(versions.filter("is_current").select("source", "sha"), ["source", "sha"], "left_semi")
    change = F.when(F.col("previous_sha").isNull(), "new").when(F.col("previous_sha") == F.col("day_sha"), "same").otherwise("changed")
    return current.join(previous, ["source", "date"], "left").select("source", "date", "sha", "day_sha", change.alias("change"))


def clashes(days: DataFrame) -> DataFrame:
    """Dates that more than one current source holds: rows are errors."""
    return days.groupBy("date").agg(F.count("*").alias("sources")).filter("sources > 1")


def missing_and_unexpected(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Two date sets to (date, what): expected but not found, found but not expected."""
    missing = expected.join(found, "date", "left_anti").select("date", F.lit("missing").alias("what"))
    return missing.union(found.join(expected, "date", "left_anti").select("date", F.lit("unexpected")))
