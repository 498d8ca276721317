"""Day checks: row counts against a moving baseline, and a verdict per day.

The baseline is recursive (whether a day counts as normal depends on the verdicts before it), so it is a
fold over the calendar and not a window. It runs as one ``aggregate`` expression over a sorted array of
days: a few thousand entries per series however many rows a day has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contract import Baseline, Limits
from .cast import FILE_DATE, WARNINGS

def _median(a: Column) -> Column:
    s, n = F.array_sort(a), F.size(a)
    middle = F.floor(n / 2).cast("int")
    return F.when(n % 2 == 1, F.element_at(s, middle + 1).cast("double")).otherwise((F.element_at(s, middle) + F.element_at(s, middle + 1)).cast("double") / 2)


def source_checks(days: DataFrame, rules: Baseline = Baseline(), carry: tuple[str, ...] = ()) -> DataFrame:
    """(date, row_count, status) to a row per calendar day: bronze_rows, baseline, change, partial and note.

    Only days with rows that are not partial join the baseline, so a long partial stretch stays flagged. Columns in
    ``carry`` go along, null on days that aren't there: what is counted per day needs no second scan to be joined.
    """
    following = F.lead("date").over(Window.orderBy("date"))  # a row per day of a series
    known = days.select("date", F.col("row_count").cast("bigint").alias("rows"), "status", F.struct(F.lit(True).alias("there"), *carry).alias("carried"), following.alias("next"))
    carried = known.schema["carried"].dataType.simpleString()
    entry = f"struct<date:date,bronze_rows:bigint,baseline:double,change:double,partial:boolean,note:string,carried:{carried}>"
    listed = known.agg(F.array_sort(F.collect_list(F.struct(*known.columns)), lambda a, b: F.datediff(a["date"], b["date"])).alias("days"))
    zero = F.from_json(F.lit('{"normal":[],"out":[]}'), f"struct<normal:array<bigint>,out:array<struct<self:{entry},next:date>>>")

    def step(state: Column, day: Column) -> Column:
        usable = ~F.coalesce((day["status"] == "empty") | (day["rows"] == 0), F.lit(False))
        some = F.size(state["normal"]) > 0
        base = F.when(usable & some, _median(state["normal"]))
        change = day["rows"] / base - 1
        partial = F.coalesce(usable & some & (day["rows"] < rules.partial_below * base), F.lit(False))
        unusual = F.coalesce(F.abs(change) > rules.warn_beyond, F.lit(False))
        note = F.when(~usable, "empty").when(partial, "partial").when(unusual, "unusual")
        last = F.slice(F.concat(state["normal"], F.array(day["rows"])), F.greatest(F.size(state["normal"]) + 2 - rules.window, F.lit(1)), rules.window)
        own = F.struct(
            day["date"].alias("date"), day["rows"].alias("bronze_rows"), base.alias("baseline"), F.round(change, 4).alias("change"), partial.alias("partial"), note.alias("note"), day["carried"].alias("carried")
        )
        # Only what is new is cast: casting the state would go over all days again at every step.
        added = F.array(F.struct(own.alias("self"), day["next"].alias("next"))).cast(f"array<struct<self:{entry},next:date>>")
        return F.struct(F.when(usable & ~partial, last).otherwise(state["normal"]).alias("normal"), F.concat(state["out"], added).alias("out"))

    folded = listed.select(F.explode(F.aggregate("days", zero, step, lambda s: s["out"])).alias("x")).select("x.self", "x.next")
    # Days that aren't there change nothing in the baseline; they are put in after it.
    absent = "'bronze_rows', cast(null as bigint), 'baseline', cast(null as double), 'change', cast(null as double), 'partial', false, 'note', 'missing'"
    gap = F.expr(f"transform(sequence(date_add(self.date, 1), date_sub(next, 1)), d -> named_struct('date', d, {absent}, 'carried', cast(null as {carried})))")
    gap = F.when(F.datediff("next", "self.date") > 1, gap).otherwise(F.expr(f"cast(array() as array<{entry}>)"))
    each = folded.select(F.explode(F.concat(F.array("self"), gap)).alias("x"))
    return each.select("x.date", "x.bronze_rows", "x.baseline", "x.change", "x.partial", "x.note", *(F.col(f"x.carried.{c}").alias(c) for c in carry))


COUNTERS = ("cast_good", "cast_quarantined", "conflict_rows", "conflict_drives", "silver_rows")


def day_counts(told: DataFrame, quarantined: DataFrame, days: DataFrame) -> DataFrame:
    """Per day of rows or of ``days``, zero where nothing is counted.

    Good, conflicting and kept rows are counted in one pass over the versions that duplicate removal tells apart:
    a row per device and day first (no further shuffle, as versions are counted by the same keys), then per day.
    """
    device = told.groupBy("date", "serial_number").agg(F.sum("_copies").alias("copies"), F.count("*").alias("versions"))
    clash = F.col("versions") > 1
    sums = {"cast_good": F.sum("copies"), "conflict_rows": F.sum(F.when(clash, F.col("versions"))), "conflict_drives": F.count_if(clash), "silver_rows": F.count_if(~clash)}
    counted = device.groupBy("date").agg(*(c.alias(n) for n, c in sums.items()))
    aside = quarantined.groupBy(F.col(FILE_DATE).alias("date")).agg(F.count("*").alias("cast_quarantined"))
    whole = counted.join(aside, "date", "full").join(days.select("date").distinct(), "date", "full")
    return whole.select("date", *(F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in COUNTERS))


def conflict_devices(conflicts: DataFrame) -> DataFrame:
    """Per day: devices among quarantine rows, by the serial number in their original text."""
    serial = F.get_json_object("raw", "$.serial_number")
    return conflicts.groupBy(F.col(FILE_DATE).alias("date")).agg(F.count_distinct(serial).alias("devices"))


def warning_counts(kept: DataFrame) -> DataFrame:
    return kept.select("date", F.explode(WARNINGS).alias("warning")).groupBy("date", "warning").agg(F.count("*").alias("n"))


def judge_days(checks: DataFrame, counts: DataFrame, limits: Limits = Limits(), noted: DataFrame | None = None) -> DataFrame:
    """A verdict per loaded day: blocked for losses of our own, else partial, warn or ok. Limits are exceeded strictly.

    ``noted``: (date, n) counts of row warnings, which make an ok day a warn day.
    """
    return judge(counts.join(checks, "date", "left"), limits, noted)


def judge(rows: DataFrame, limits: Limits = Limits(), noted: DataFrame | None = None) -> DataFrame:
    """The verdicts of ``judge_days`` on rows that have a day's counts and its checks."""
    if noted is not None:
        rows = rows.join(noted.groupBy("date").agg(F.sum("n").alias("row_warnings")), "date", "left")
    else:
        rows = rows.withColumn("row_warnings", F.lit(0))
    bronze = F.coalesce("bronze_rows", F.lit(0))
    quarantined = F.col("cast_quarantined") + F.col("conflict_rows")
    lost = F.col("cast_good") + F.col("cast_quarantined") != bronze
    share = F.coalesce(quarantined / F.nullif(bronze, F.lit(0)), F.when(quarantined > 0, 1.0).otherwise(0.0))
    copies = F.col("cast_good") - F.col("conflict_rows") - F.col("silver_rows")
    blocks = F.array_compact(
        F.array(
            F.when(lost, "rows lost"),
            F.when((quarantined > 0) & (share > limits.quarantined_share), "too many rows quarantined"),
            F.when(F.col("conflict_drives") > limits.conflicting_devices, "too many devices with conflicting duplicates"),
        )
    )
    warnings = F.array_compact(
        F.array(
            F.col("note"),
            F.when((quarantined > 0) & (share <= limits.quarantined_share), "rows quarantined"),
            F.when(copies != 0, "exact duplicate rows removed"),
            F.when(F.coalesce("row_warnings", F.lit(0)) > 0, "rows with warnings"),
        )
    )
    status = F.when(F.size(blocks) > 0, "blocked").when(F.col("partial"), "partial").when(F.size(warnings) > 0, "warn").otherwise("ok")
    return rows.select(
        "date", status.alias("status"), blocks.alias("blocks"), warnings.alias("warnings"), bronze.alias("bronze_rows"), "silver_rows", quarantined.alias("quarantined_rows"),
        copies.alias("exact_copies"), F.col("baseline").alias("usual_rows"),
    )


def continuity(rows: DataFrame, attributes: tuple[str, ...] = ("model", "capacity_bytes"), limits: Limits = Limits()) -> DataFrame:
    """Per day: devices whose attributes differ from their previous row's, and devices seen after a failure; over the limit, the day would be blocked."""
    before = Window.partitionBy("serial_number").orderBy("date")
    changed = reduce(lambda a, b: a | b, [F.coalesce(F.col(a) != F.lag(a).over(before), F.lit(False)) for a in attributes])
    failed = F.coalesce(F.max(F.col("failure").cast("int")).over(before.rowsBetween(Window.unboundedPreceding, -1)) == 1, F.lit(False))
    marked = rows.select("date", changed.alias("changed"), failed.alias("failed"))
    counted = marked.groupBy("date").agg(F.count_if("changed").alias("changed_devices"), F.count_if("failed").alias("reappeared_devices"))
    return counted.withColumn("too_many", F.greatest("changed_devices", "reappeared_devices") > limits.conflicting_devices)


def defect_verdicts(days: DataFrame, defects: dict) -> DataFrame:
    """Verdicts of listed days that are not loaded: a known gap, with the real row count."""
    spark = days.sparkSession
    listed = spark.createDataFrame(sorted(defects.items()), "date date, reason string")
    return days.join(F.broadcast(listed), "date").select(  # the list is part of the contract
        "date", F.lit("warn").alias("status"), F.expr("cast(array() as array<string>)").alias("blocks"), F.array(F.concat(F.lit("known source defect, not loaded: "), "reason")).alias("warnings"),
        F.col("row_count").cast("bigint").alias("bronze_rows"), F.lit(0).cast("bigint").alias("silver_rows"), F.lit(0).cast("bigint").alias("quarantined_rows"),
        F.lit(0).cast("bigint").alias("exact_copies"), F.lit(None).cast("double").alias("usual_rows"),
    )
