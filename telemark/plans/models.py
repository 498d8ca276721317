"""Reliability facts, marts and machine-learning tables over the daily panel.

The panel ("silver") has one row per device and day: date, serial_number, model, capacity_bytes,
failure, and for the ML tables hours and counters. Each model reads only the columns it needs, so scans
are pruned; period tables build on the small daily and quarterly facts and not on the panel. No join is
hinted except against seeds, whose size is a parameter: dimensions and failures are left to adaptive
execution, which broadcasts them only after their size is known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.telemetry import afr_pct, age_days, any_positive, count_where, is_boot, quarter_end, year_quarter

# Counters, horizon and warm-up of the failure tables, in days.
COUNTERS = ("realloc", "uncorrect", "timeout", "pending", "offline")
HORIZON, WARM_UP = 30, 37


def fleet_daily(silver: DataFrame) -> DataFrame:
    """Per day: devices that reported, and failures."""
    return silver.groupBy("date").agg(F.count("*").alias("drives"), count_where(F.col("failure")).alias("failures"))


def model_daily(silver: DataFrame) -> DataFrame:
    """Per day and model; a null model is a group of its own."""
    return silver.groupBy("date", "model").agg(F.count("*").alias("drive_days"), count_where(F.col("failure")).alias("failures"))


def first_pattern(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Rows, one for each model, with the manufacturer of the first pattern by priority that the model is LIKE; null if none is."""
    matched = rows.join(F.broadcast(patterns), F.expr("model LIKE pattern"), "left")  # patterns are a seed
    rank = F.row_number().over(Window.partitionBy("model").orderBy("priority"))
    return matched.withColumn("rank", rank).filter("rank = 1").drop("rank", "priority", "pattern")


def usual_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent non-null value per key; ties go to the larger value."""
    counted = rows.filter(F.col(value).isNotNull()).groupBy(key, value).count()
    return counted.groupBy(key).agg(F.max_by(value, F.struct("count", value)).alias(value))


def dim_model(silver: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per model: first and last day, devices, days, usual capacity and manufacturer, from one scan.

    Days become a row per device and capacity, those a row per model and capacity, and those a row per model. A device
    counts where its first capacity is, so devices are counted once without gathering a model's devices anywhere.
    """
    days = silver.select("model", "serial_number", "date", "capacity_bytes").filter(F.col("model").isNotNull())
    device = days.groupBy("model", "serial_number", "capacity_bytes").agg(F.count("*").alias("n"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))
    first = F.row_number().over(Window.partitionBy("model", "serial_number").orderBy("capacity_bytes")) == 1
    ends = (F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    size = device.withColumn("first", first).groupBy("model", "capacity_bytes").agg(F.sum("n").alias("n"), F.count_if("first").alias("drives"), *ends)
    usual = F.max_by("capacity_bytes", F.when(F.col("capacity_bytes").isNotNull(), F.struct("n", "capacity_bytes")))
    each = size.groupBy("model").agg(*ends, F.sum("drives").alias("drives"), F.sum("n").alias("drive_days"), usual.alias("capacity_bytes"))
    return first_pattern(each, patterns).select(
        "model", "manufacturer", "capacity_bytes", F.round(F.col("capacity_bytes") / F.lit(1e12), 1).alias("capacity_tb"), "first_seen", "last_seen", "drives", "drive_days"
    )


def device_quarter(silver: DataFrame) -> DataFrame:
    """Per quarter and device: last model, days, failures, slot, capacity, presence at the quarter's end."""
    last_day = F.max("date")
    return (
        silver.groupBy(year_quarter(F.col("date")).alias("year_quarter"), "serial_number")
        .agg(
            F.max_by("model", F.struct("date", "model")).alias("model"),
            F.count("*").alias("drive_days"),
            count_where(F.col("failure")).alias("failures"),
            F.bool_or(F.col("slot_num").isNotNull()).alias("ever_in_a_slot"),
            F.max("capacity_bytes").alias("capacity_bytes"),
            last_day.alias("last_day"),
        )
        .select("*", (F.col("last_day") == quarter_end(F.col("last_day"))).alias("at_quarter_end"), is_boot(F.col("capacity_bytes")).alias("is_boot"))
    )


def status_by_quarter(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy(year_quarter(F.col("date")).alias("year_quarter")).agg(
        count_where(F.col("status") == "partial").alias("partial_days"),
        count_where(F.col("status") == "blocked").alias("blocked_days"),
        count_where(F.col("silver_rows") == 0).alias("days_without_data"),
    )


def afr_model_quarter(daily: DataFrame, dim: DataFrame, verdicts: DataFrame) -> DataFrame:
    """AFR per model and quarter, unfiltered; provisional where days are blocked (null without verdicts)."""
    per_model = daily.groupBy(year_quarter(F.col("date")).alias("year_quarter"), "model").agg(F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"))
    return (
        per_model.join(dim.select("model", "manufacturer", "capacity_tb"), "model", "left")
        .join(status_by_quarter(verdicts), "year_quarter", "left")
        .select(
            "year_quarter", "model", "manufacturer", "capacity_tb", "drive_days", "failures",
            afr_pct(F.col("failures"), F.col("drive_days")).alias("afr_pct"),
            "partial_days", "blocked_days", "days_without_data", (F.col("blocked_days") > 0).alias("provisional"),
        )
    )


@dataclass(frozen=True)
class Era:
    """Which models are large enough until a period: devices at the quarter's end, and days if ``min_days`` is set (both exceeded then)."""

    before: str | None
    min_devices: int
    min_days: int | None = None

    def holds(self, devices: Column, days: Column) -> Column:
        return devices >= self.min_devices if self.min_days is None else (devices > self.min_devices) & (days > self.min_days)


# Which models count as large, by era.
ERAS = (Era("2019", 45), Era("2023", 60), Era(None, 100, 10_000))


def large_enough(eras: tuple[Era, ...]) -> Column:
    """Periods compare as text: '2018-Q4' < '2019'."""
    devices, days = F.col("drives_at_end"), F.col("drive_days")
    chosen = eras[-1].holds(devices, days)
    for era in reversed(eras[:-1]):
        chosen = F.when(F.col("year_quarter") < era.before, era.holds(devices, days)).otherwise(chosen)
    return chosen


def afr_fleet_quarter(quarters: DataFrame, eras: tuple[Era, ...] = ERAS) -> DataFrame:
    """Fleet AFR per quarter: data devices of models that are large enough in their era. Quarters without data devices have no row."""
    per_model = (
        quarters.groupBy("year_quarter", "model", "is_boot")
        .agg(F.count("*").alias("devices"), F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"), count_where(F.col("at_quarter_end")).alias("drives_at_end"))
        .withColumn("in_table", ~F.col("is_boot") & large_enough(eras))
    )
    of = lambda condition, c: F.sum(F.when(condition, F.col(c)).otherwise(0))
    inside, boot = F.col("in_table"), F.col("is_boot")
    summed = per_model.groupBy("year_quarter").agg(
        F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"),
        of(inside, "drive_days").alias("afr_drive_days"), of(inside, "failures").alias("afr_failures"),
        of(~inside & ~boot, "drive_days").alias("small_model_drive_days"), of(boot, "devices").alias("boot_drives"), count_where(~boot).alias("data_models"),
    )
    return summed.filter("data_models > 0").select(
        "year_quarter", "drive_days", "failures",
        afr_pct(F.col("failures"), F.col("drive_days")).alias("afr_pct_all_drives"),
        "afr_drive_days", "afr_failures",
        afr_pct(F.col("afr_failures"), F.col("afr_drive_days")).alias("afr_pct"),
        "small_model_drive_days", "boot_drives",
    )


def afr_fleet_year(fleet_quarters: DataFrame) -> DataFrame:
    summed = fleet_quarters.groupBy(F.substring("year_quarter", 1, 4).alias("year")).agg(F.sum("afr_drive_days").alias("afr_drive_days"), F.sum("afr_failures").alias("afr_failures"))
    return summed.select("year", "afr_drive_days", "afr_failures", afr_pct(F.col("afr_failures"), F.col("afr_drive_days")).alias("afr_pct"))


def trailing(days: int, *keys: str):
    """A window over the last ``days`` calendar days, today included; gaps don't stretch it."""
    return Window.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)


def fleet_health(daily: DataFrame, dim: DataFrame, days: int = 30) -> DataFrame:
    """Per day, manufacturer and role: devices, failures and the AFR of the last 30 days."""
    role = F.when(F.col("capacity_bytes") < 1_000_000_000_000, "boot").otherwise("data")
    summed = (
        daily.join(dim.select("model", "manufacturer", "capacity_bytes"), "model", "left")
        .groupBy("date", F.coalesce("manufacturer", F.lit("Unknown")).alias("manufacturer"), role.alias("drive_role"))
        .agg(F.sum("drive_days").alias("drives"), F.sum("failures").alias("failures"))
    )
    w = trailing(days, "manufacturer", "drive_role")
    rolled = summed.select("*", F.sum("drives").over(w).alias("rolling_30d_drive_days"), F.sum("failures").over(w).alias("rolling_30d_failures"))
    return rolled.withColumn("rolling_30d_afr_pct", afr_pct(F.col("rolling_30d_failures"), F.col("rolling_30d_drive_days")))


def first_failures(silver: DataFrame) -> DataFrame:
    return silver.filter("failure").groupBy("serial_number").agg(F.min("date").alias("fail_date"))


def device_failure(silver: DataFrame, dim: DataFrame, counters: tuple[str, ...] = COUNTERS) -> DataFrame:
    """The first failure of each device with its last readings, and their change since 7-14 and 30-37 days before."""
    failed = first_failures(silver)
    recent = silver.select("serial_number", "date", "model", "hours", *counters).join(failed, "serial_number").filter(F.col("date").between(F.date_sub("fail_date", WARM_UP), F.col("fail_date")))

    def between(c: str, far: int, near: int) -> Column:
        inside = F.col("date").between(F.date_sub("fail_date", far), F.date_sub("fail_date", near))
        return F.max_by(F.when(inside, F.col(c)), F.when(inside, F.col("date")))

    summary = recent.groupBy("serial_number", "fail_date").agg(
        F.max_by("model", "date").alias("model"),
        F.max_by("hours", "date").alias("hours"),
        *(F.max_by(c, "date").alias(c) for c in counters),
        *(between(c, 14, 7).alias(f"{c}_7") for c in counters),
        *(between(c, WARM_UP, 30).alias(f"{c}_30") for c in counters),
        F.count("*").alias("rows_in_window"),
    )
    changes = [x for c in counters for x in (F.col(c), (F.col(c) - F.col(f"{c}_7")).alias(f"{c}_7d"), (F.col(c) - F.col(f"{c}_30")).alias(f"{c}_30d"))]
    return summary.join(dim.select("model", "manufacturer"), "model", "left").select(
        "serial_number", "model", "manufacturer", "fail_date", age_days(F.col("hours")).alias("age_days"), *changes, any_positive([F.col(c) for c in counters]).alias("any_warning"), "rows_in_window"
    )


def feature_day(silver: DataFrame, dim: DataFrame, start: str, counters: tuple[str, ...] = COUNTERS) -> DataFrame:
    """Point-in-time features per device and day with a three-valued label.

    37 days before ``start`` are read so that look-backs are complete, then dropped. Label: 1 if the device
    fails within 30 days after the day, 0 if those days are all known, else null.
    """
    first = F.lit(start).cast("date")
    failed = first_failures(silver)
    bounds = silver.agg(F.max("date").alias("data_end"))
    base = silver.filter((F.col("date") >= F.date_sub(first, WARM_UP)) & ~is_boot(F.col("capacity_bytes"))).select("serial_number", "date", "model", "hours", *counters)
    by_day = Window.partitionBy("serial_number").orderBy(F.unix_date("date"))
    back_7, back_30, month = by_day.rangeBetween(-14, -7), by_day.rangeBetween(-WARM_UP, -30), by_day.rangeBetween(-29, 0)
    seen = base.select(
        "*",
        *(F.last(c).over(back_7).alias(f"{c}_7") for c in counters),
        *(F.last(c).over(back_30).alias(f"{c}_30") for c in counters),
        *(F.max(c).over(month).alias(f"{c}_max_30d") for c in counters),
    )
    ends = F.date_add("date", HORIZON)
    label = F.when((F.col("fail_date") > F.col("date")) & (F.col("fail_date") <= ends), 1).when(ends <= F.col("data_end"), 0)
    changes = [x for c in counters for x in (F.col(c), (F.col(c) - F.col(f"{c}_7")).alias(f"{c}_7d"), (F.col(c) - F.col(f"{c}_30")).alias(f"{c}_30d"), F.col(f"{c}_max_30d"))]
    return (
        seen.filter(F.col("date") >= first)
        .crossJoin(F.broadcast(bounds))  # one row
        .join(failed, "serial_number", "left")
        .filter(F.col("fail_date").isNull() | (F.col("date") < F.col("fail_date")))
        .join(dim.select("model", "manufacturer"), "model", "left")
        .select("serial_number", "date", "model", "manufacturer", age_days(F.col("hours")).alias("age_days"), *changes, label.alias("label_fail_30d"))
    )


def survival(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Per device: observed life up to its first failure. Devices there from the first day on are left out: their start is unknown."""
    rows = silver.select("serial_number", "date", "model", "failure")
    bounds = rows.agg(F.min("date").alias("data_start"), F.max("date").alias("data_end"))
    life = (
        rows.join(first_failures(rows), "serial_number", "left")
        .filter(F.col("fail_date").isNull() | (F.col("date") <= F.col("fail_date")))
        .groupBy("serial_number")
        .agg(F.min_by("model", "date").alias("model"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.max("fail_date").alias("fail_date"))
    )
    reason = F.when(F.col("fail_date").isNotNull(), "failed").when(F.col("last_seen") == F.col("data_end"), "still_running").otherwise("removed")
    return (
        life.crossJoin(F.broadcast(bounds))  # one row
        .filter(F.col("first_seen") > F.col("data_start"))
        .join(dim.select("model", "manufacturer"), "model", "left")
        .select(
            "serial_number", "model", "manufacturer", "first_seen", "last_seen",
            (F.datediff("last_seen", "first_seen") + 1).alias("duration_days"), F.col("fail_date").isNotNull().cast("int").alias("event"), reason.alias("end_reason"),
        )
    )


def kaplan_meier(lives: DataFrame, group: str, min_devices: int = 5_000, min_at_risk: int = 1_000) -> DataFrame:
    """Survival curve per group: after each duration, devices at risk, failures and the share still alive.

    Durations are aggregated before any window, so a window row stands for a duration and not for a device.
    """
    by_duration = lives.groupBy(group, "duration_days").agg(F.count("*").alias("ended"), F.sum("event").cast("bigint").alias("failures"))
    whole = Window.partitionBy(group)
    later = whole.orderBy("duration_days").rowsBetween(0, Window.unboundedFollowing)
    so_far = whole.orderBy("duration_days").rowsBetween(Window.unboundedPreceding, 0)
    at_risk = by_duration.select("*", F.sum("ended").over(later).alias("at_risk"), F.sum("ended").over(whole).alias("drives"))
    alive = F.col("at_risk") - F.col("failures")
    step = F.when(alive > 0, F.log(alive / F.col("at_risk"))).otherwise(F.lit(0.0))
    dead = F.max((alive == 0).cast("int")).over(so_far)
    curve = at_risk.withColumn("survival", F.when(dead == 1, 0.0).otherwise(F.exp(F.sum(step).over(so_far))))
    return curve.filter((F.col("drives") >= min_devices) & (F.col("at_risk") >= min_at_risk)).select(group, "duration_days", "at_risk", "failures", "drives", F.round("survival", 9).alias("survival"))


def alive_after(curve: DataFrame, group: str, years: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """S(t) at whole years, null where the curve ends before, and where it ends."""

    def at(y: int) -> Column:
        days = int(y * 365.25)
        reached = F.max("duration_days") >= y * 365.25
        return F.when(reached, F.coalesce(F.max_by(F.when(F.col("duration_days") <= days, F.col("survival")), F.when(F.col("duration_days") <= days, F.col("duration_days"))), F.lit(1.0)))

    return curve.groupBy(group).agg(*(at(y).alias(f"alive_{y}y") for y in years), F.round(F.max("duration_days") / F.lit(365.25), 1).alias("curve_ends_years"))


def reconcile(reference: DataFrame, fleet_quarters: DataFrame, fleet_years: DataFrame, model_quarters: DataFrame) -> DataFrame:
    """Reference figures next to ours: fleet by quarter or '<year>-Y', model by exact name or as its last word."""
    fleet = fleet_quarters.select(F.col("year_quarter").alias("f_period"), F.col("afr_pct").alias("f_afr")).union(fleet_years.select(F.concat("year", F.lit("-Y")), "afr_pct"))
    models = model_quarters.select(F.col("year_quarter").alias("m_period"), F.col("model").alias("m_model"), F.col("afr_pct").alias("m_afr"))
    ours = F.coalesce("f_afr", "m_afr")
    return (
        reference.join(fleet, (F.col("scope") == "fleet") & (F.col("f_period") == F.col("period")), "left")
        .join(models, (F.col("scope") == "model") & (F.col("m_period") == F.col("period")) & ((F.col("m_model") == F.col("model")) | F.expr("m_model LIKE concat('% ', model)")), "left")
        .select(
            "period", "scope", "model", "status", F.col("afr_pct").alias("published_afr_pct"), ours.alias("our_afr_pct"),
            F.round(ours - F.col("afr_pct"), 2).alias("difference"), F.when(F.col("scope") == "model", 0.01).otherwise(0.05).alias("tolerance"), "note",
        )
    )
