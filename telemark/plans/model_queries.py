"""Queries that build the reliability models over the driver's tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.telemetry import year_quarter
from . import models
from .models import COUNTERS, Era
from .panels import (
    PART_PANEL,
    PART_PATTERNS,
    SUPPLIER_PANEL,
    SUPPLIER_PATTERNS,
    part_panel,
    patterns,
    supplier_panel,
    values_sql,
)
from .registry import query, with_sql

# Parameters of the queries: the panels' years and sizes are small, so eras and minimums are too.
ERAS = (Era("1997", 2), Era("1999", 3), Era(None, 3, 20))
FEATURE_START = "1998-01-01"
KM_MIN_DEVICES, KM_MIN_AT_RISK = 50, 20

AFR = "round({f} / (nullif({d}, 0) / CAST(365.0 AS DOUBLE)) * 100, 2)"
YEAR_QUARTER = "CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR)"


def afr_sql(failures: str, days: str) -> str:
    return AFR.format(f=f"CAST({failures} AS DOUBLE)", d=days)


PATTERNS_PP = values_sql(PART_PATTERNS, "seed", "priority, pattern, manufacturer")
PATTERNS_SP = values_sql(SUPPLIER_PATTERNS, "seed", "priority, pattern, manufacturer")


def dim_sql(panel: str) -> str:
    return f"""dim AS (
  SELECT p.model, m.manufacturer, c.capacity_bytes, round(c.capacity_bytes / 1e12, 1) AS capacity_tb, p.first_seen, p.last_seen, p.drives, p.drive_days
  FROM (SELECT model, min(date) AS first_seen, max(date) AS last_seen, count(DISTINCT serial_number) AS drives, count(*) AS drive_days FROM {panel} WHERE model IS NOT NULL GROUP BY model) p
  LEFT JOIN (SELECT model, arg_min(manufacturer, priority) AS manufacturer FROM (SELECT DISTINCT model FROM {panel}) JOIN seed ON model LIKE pattern GROUP BY model) m ON m.model = p.model
  LEFT JOIN (SELECT model, capacity_bytes FROM (SELECT model, capacity_bytes, row_number() OVER (PARTITION BY model ORDER BY count(*) DESC, capacity_bytes DESC) AS k
             FROM {panel} WHERE capacity_bytes IS NOT NULL GROUP BY model, capacity_bytes) WHERE k = 1) c ON c.model = p.model)"""


MODEL_DAILY = "md AS (SELECT date, model, count(*) AS drive_days, count(*) FILTER (failure) AS failures FROM pp GROUP BY date, model)"
QUARTERS = f"""dq AS (
  SELECT yq AS year_quarter, serial_number, model, drive_days, failures, ever_in_a_slot, capacity_bytes, last_day,
         last_day = CAST(last_day(date_trunc('quarter', last_day) + INTERVAL 2 MONTH) AS DATE) AS at_quarter_end, coalesce(capacity_bytes < 1000000000000, false) AS is_boot
  FROM (SELECT {YEAR_QUARTER} AS yq, serial_number, arg_max_null(model, (date, model)) AS model, count(*) AS drive_days, count(*) FILTER (failure) AS failures,
               bool_or(slot_num IS NOT NULL) AS ever_in_a_slot, max(capacity_bytes) AS capacity_bytes, max(date) AS last_day FROM pp GROUP BY yq, serial_number))"""
# Verdicts stand in for the load history: a day of under ten rows is partial, days that are multiples of 97 are blocked and empty.
VERDICTS = """dv AS (SELECT date, CASE WHEN date_diff('day', DATE '1995-01-01', date) % 97 = 0 THEN 'blocked' WHEN count(*) < 10 THEN 'partial' ELSE 'ok' END AS status,
  CASE WHEN date_diff('day', DATE '1995-01-01', date) % 97 = 0 THEN 0 ELSE count(*) END AS silver_rows FROM pp GROUP BY date)"""
FLEET_QUARTER = f"""fq AS (
  SELECT e.year_quarter, e.drive_days, e.failures, {afr_sql("e.failures", "e.drive_days")} AS afr_pct_all_drives, c.afr_drive_days, c.afr_failures,
         {afr_sql("c.afr_failures", "c.afr_drive_days")} AS afr_pct, c.small_model_drive_days, e.boot_drives
  FROM (SELECT year_quarter, CAST(sum(CASE WHEN in_table THEN drive_days ELSE 0 END) AS BIGINT) AS afr_drive_days, CAST(sum(CASE WHEN in_table THEN failures ELSE 0 END) AS BIGINT) AS afr_failures,
               CAST(sum(CASE WHEN in_table THEN 0 ELSE drive_days END) AS BIGINT) AS small_model_drive_days
        FROM (SELECT *, CASE WHEN year_quarter < '1997' THEN ends >= 2 WHEN year_quarter < '1999' THEN ends >= 3 ELSE ends > 3 AND drive_days > 20 END AS in_table
              FROM (SELECT year_quarter, model, sum(drive_days) AS drive_days, sum(failures) AS failures, count(*) FILTER (at_quarter_end) AS ends FROM dq WHERE NOT is_boot GROUP BY 1, 2))
        GROUP BY year_quarter) c
  JOIN (SELECT year_quarter, CAST(sum(drive_days) AS BIGINT) AS drive_days, CAST(sum(failures) AS BIGINT) AS failures, count(*) FILTER (is_boot) AS boot_drives FROM dq GROUP BY 1) e USING (year_quarter))"""
FLEET_YEAR = f"""fy AS (SELECT substr(year_quarter, 1, 4) AS year, CAST(sum(afr_drive_days) AS BIGINT) AS afr_drive_days, CAST(sum(afr_failures) AS BIGINT) AS afr_failures,
  {afr_sql("sum(afr_failures)", "sum(afr_drive_days)")} AS afr_pct FROM fq GROUP BY 1)"""
MODEL_QUARTER = f"""mq AS (
  SELECT p.year_quarter, p.model, d.manufacturer, d.capacity_tb, p.drive_days, p.failures, {afr_sql("p.failures", "p.drive_days")} AS afr_pct,
         s.partial_days, s.blocked_days, s.days_without_data, s.blocked_days > 0 AS provisional
  FROM (SELECT {YEAR_QUARTER} AS year_quarter, model, CAST(sum(drive_days) AS BIGINT) AS drive_days, CAST(sum(failures) AS BIGINT) AS failures FROM md GROUP BY 1, 2) p
  LEFT JOIN dim d ON d.model = p.model
  LEFT JOIN (SELECT {YEAR_QUARTER} AS year_quarter, count(*) FILTER (status = 'partial') AS partial_days, count(*) FILTER (status = 'blocked') AS blocked_days,
             count(*) FILTER (silver_rows = 0) AS days_without_data FROM dv GROUP BY 1) s ON s.year_quarter = p.year_quarter)"""


def verdicts(daily: DataFrame) -> DataFrame:
    """Verdicts by rule, from the daily fact of models."""
    blocked = F.datediff("date", F.lit("1995-01-01").cast("date")) % 97 == 0
    return daily.groupBy("date").agg(F.sum("drive_days").alias("n")).select(
        "date", F.when(blocked, "blocked").when(F.col("n") < 10, "partial").otherwise("ok").alias("status"), F.when(blocked, 0).otherwise(F.col("n")).alias("silver_rows")
    )


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_model(part_panel(spark, sf_dir), patterns(spark, PART_PATTERNS))


def supplier_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_model(supplier_panel(spark, sf_dir), patterns(spark, SUPPLIER_PATTERNS))


@query(with_sql("SELECT date, count(*) AS drives, count(*) FILTER (failure) AS failures FROM pp GROUP BY date", PART_PANEL))
def fleet_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fleet_daily(part_panel(spark, sf_dir))


@query(with_sql("SELECT * FROM md", PART_PANEL, MODEL_DAILY))
def model_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.model_daily(part_panel(spark, sf_dir))


@query(with_sql("SELECT * FROM dim", PART_PANEL, PATTERNS_PP, dim_sql("pp")))
def dim_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_dim(spark, sf_dir)


@query(with_sql("SELECT * FROM dq", PART_PANEL, QUARTERS))
def device_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.device_quarter(part_panel(spark, sf_dir))


@query(with_sql("SELECT * FROM mq", PART_PANEL, MODEL_DAILY, PATTERNS_PP, dim_sql("pp"), VERDICTS, MODEL_QUARTER))
def afr_model_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = part_panel(spark, sf_dir)
    daily = models.model_daily(panel)
    return models.afr_model_quarter(daily, part_dim(spark, sf_dir), verdicts(daily))


@query(with_sql("SELECT * FROM fq", PART_PANEL, QUARTERS, FLEET_QUARTER))
def afr_fleet_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.afr_fleet_quarter(models.device_quarter(part_panel(spark, sf_dir)), ERAS)


@query(with_sql("SELECT * FROM fy", PART_PANEL, QUARTERS, FLEET_QUARTER, FLEET_YEAR))
def afr_fleet_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.afr_fleet_year(afr_fleet_quarter(spark, sf_dir))


HEALTH = f"""fh AS (
  SELECT *, {afr_sql("rolling_30d_failures", "rolling_30d_drive_days")} AS rolling_30d_afr_pct
  FROM (SELECT *, CAST(sum(drives) OVER w AS BIGINT) AS rolling_30d_drive_days, CAST(sum(failures) OVER w AS BIGINT) AS rolling_30d_failures
        FROM (SELECT f.date, coalesce(d.manufacturer, 'Unknown') AS manufacturer, CASE WHEN d.capacity_bytes < 1000000000000 THEN 'boot' ELSE 'data' END AS drive_role,
                     CAST(sum(f.drive_days) AS BIGINT) AS drives, CAST(sum(f.failures) AS BIGINT) AS failures
              FROM md f LEFT JOIN dim d ON d.model = f.model GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY manufacturer, drive_role ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)))"""
MODEL_DAILY_SP = MODEL_DAILY.replace("FROM pp", "FROM sp")


@query(with_sql("SELECT * FROM fh", SUPPLIER_PANEL, MODEL_DAILY_SP, PATTERNS_SP, dim_sql("sp"), HEALTH))
def fleet_health_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fleet_health(models.model_daily(supplier_panel(spark, sf_dir)), supplier_dim(spark, sf_dir))


FAILS = "fails AS (SELECT serial_number, min(date) AS fail_date FROM {panel} WHERE failure GROUP BY serial_number)"


def _failure_sql() -> str:
    inner = ", ".join(
        f"arg_max_null({c}, date) AS {c}, arg_max_null({c}, date) FILTER (date BETWEEN fail_date - 14 AND fail_date - 7) AS {c}_b7, "
        f"arg_max_null({c}, date) FILTER (date BETWEEN fail_date - 37 AND fail_date - 30) AS {c}_b30"
        for c in COUNTERS
    )
    outer = ", ".join(f"s.{c}, s.{c} - s.{c}_b7 AS {c}_7d, s.{c} - s.{c}_b30 AS {c}_30d" for c in COUNTERS)
    warned = " OR ".join(f"coalesce(s.{c}, 0) > 0" for c in COUNTERS)
    return f"""df AS (SELECT s.serial_number, s.model, m.manufacturer, s.fail_date, CASE WHEN s.hours BETWEEN 0 AND 175200 THEN s.hours // 24 END AS age_days, {outer},
  ({warned}) AS any_warning, s.rows_in_window
  FROM (SELECT serial_number, fail_date, arg_max_null(model, date) AS model, arg_max_null(hours, date) AS hours, {inner}, count(*) AS rows_in_window
        FROM sp JOIN fails USING (serial_number) WHERE date BETWEEN fail_date - 37 AND fail_date GROUP BY 1, 2) s LEFT JOIN dim m ON m.model = s.model)"""


DEVICE_FAILURE = (SUPPLIER_PANEL, PATTERNS_SP, dim_sql("sp"), FAILS.format(panel="sp"), _failure_sql())


@query(with_sql("SELECT * FROM df", *DEVICE_FAILURE))
def device_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.device_failure(supplier_panel(spark, sf_dir), supplier_dim(spark, sf_dir))


def _feature_sql() -> str:
    day = "PARTITION BY serial_number ORDER BY date RANGE BETWEEN INTERVAL {} DAY PRECEDING AND {}"
    inner = ", ".join(
        f"last_value({c}) OVER ({day.format(14, 'INTERVAL 7 DAY PRECEDING')}) AS {c}_b7, last_value({c}) OVER ({day.format(37, 'INTERVAL 30 DAY PRECEDING')}) AS {c}_b30, "
        f"max({c}) OVER ({day.format(29, 'CURRENT ROW')}) AS {c}_max_30d"
        for c in COUNTERS
    )
    outer = ", ".join(f"w.{c}, w.{c} - w.{c}_b7 AS {c}_7d, w.{c} - w.{c}_b30 AS {c}_30d, w.{c}_max_30d" for c in COUNTERS)
    return f"""fd AS (SELECT w.serial_number, w.date, w.model, m.manufacturer, CASE WHEN w.hours BETWEEN 0 AND 175200 THEN w.hours // 24 END AS age_days, {outer},
  CASE WHEN f.fail_date > w.date AND f.fail_date <= w.date + 30 THEN 1 WHEN w.date + 30 <= b.data_end THEN 0 END AS label_fail_30d
  FROM (SELECT *, {inner} FROM sp WHERE date >= DATE '{FEATURE_START}' - 37 AND NOT coalesce(capacity_bytes < 1000000000000, false)) w
  CROSS JOIN (SELECT max(date) AS data_end FROM sp) b LEFT JOIN fails f ON f.serial_number = w.serial_number LEFT JOIN dim m ON m.model = w.model
  WHERE w.date >= DATE '{FEATURE_START}' AND (f.fail_date IS NULL OR w.date < f.fail_date))"""


FEATURE_DAY = (SUPPLIER_PANEL, PATTERNS_SP, dim_sql("sp"), FAILS.format(panel="sp"), _feature_sql())


@query(with_sql("SELECT * FROM fd", *FEATURE_DAY))
def feat_drive_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.feature_day(supplier_panel(spark, sf_dir), supplier_dim(spark, sf_dir), FEATURE_START)


SURVIVAL = """sv AS (
  SELECT l.serial_number, l.model, m.manufacturer, l.first_seen, l.last_seen, CAST(date_diff('day', l.first_seen, l.last_seen) + 1 AS INTEGER) AS duration_days,
         CASE WHEN l.fail_date IS NOT NULL THEN 1 ELSE 0 END AS event,
         CASE WHEN l.fail_date IS NOT NULL THEN 'failed' WHEN l.last_seen = b.data_end THEN 'still_running' ELSE 'removed' END AS end_reason
  FROM (SELECT r.serial_number, arg_min(r.model, r.date) AS model, min(r.date) AS first_seen, max(r.date) AS last_seen, max(f.fail_date) AS fail_date
        FROM pp r LEFT JOIN fails f ON f.serial_number = r.serial_number WHERE f.fail_date IS NULL OR r.date <= f.fail_date GROUP BY 1) l
  CROSS JOIN (SELECT min(date) AS data_start, max(date) AS data_end FROM pp) b LEFT JOIN dim m ON m.model = l.model WHERE l.first_seen > b.data_start)"""
SURVIVAL_CTES = (PART_PANEL, PATTERNS_PP, dim_sql("pp"), FAILS.format(panel="pp"), SURVIVAL)


@query(with_sql("SELECT * FROM sv", *SURVIVAL_CTES))
def surv_drive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.survival(part_panel(spark, sf_dir), part_dim(spark, sf_dir))


CURVE = f"""km AS (
  SELECT manufacturer, duration_days, at_risk, failures, drives, round(CASE WHEN dead = 1 THEN 0.0 ELSE exp(logs) END, 9) AS survival
  FROM (SELECT *, sum(CASE WHEN at_risk > failures THEN ln(CAST(at_risk - failures AS DOUBLE) / at_risk) ELSE 0 END) OVER w AS logs, max(CASE WHEN at_risk = failures THEN 1 ELSE 0 END) OVER w AS dead
        FROM (SELECT manufacturer, duration_days, CAST(failures AS BIGINT) AS failures, CAST(sum(ended) OVER (PARTITION BY manufacturer ORDER BY duration_days DESC) AS BIGINT) AS at_risk,
                     CAST(sum(ended) OVER (PARTITION BY manufacturer) AS BIGINT) AS drives
              FROM (SELECT manufacturer, duration_days, count(*) AS ended, sum(event) AS failures FROM sv GROUP BY 1, 2))
        WINDOW w AS (PARTITION BY manufacturer ORDER BY duration_days))
  WHERE drives >= {KM_MIN_DEVICES} AND at_risk >= {KM_MIN_AT_RISK})"""


@query(with_sql("SELECT * FROM km", *SURVIVAL_CTES, CURVE))
def km_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.kaplan_meier(surv_drive(spark, sf_dir), "manufacturer", KM_MIN_DEVICES, KM_MIN_AT_RISK)


def _alive_sql() -> str:
    at = lambda y: f"CASE WHEN max(duration_days) >= {y} * 365.25 THEN coalesce(arg_max(survival, duration_days) FILTER (duration_days <= {int(y * 365.25)}), 1.0) END AS alive_{y}y"
    return f"SELECT manufacturer, {at(1)}, {at(3)}, {at(5)}, round(max(duration_days) / CAST(365.25 AS DOUBLE), 1) AS curve_ends_years FROM km GROUP BY 1"


@query(with_sql(_alive_sql(), *SURVIVAL_CTES, CURVE))
def km_alive_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.alive_after(km_by_group(spark, sf_dir), "manufacturer")


# Reference figures to reconcile with; the last is a documented gap.
REFERENCE = (
    ("1996-Q2", "fleet", None, 400.0, "check", "a quarter"),
    ("1997-Q4", "fleet", None, 420.5, "check", "a quarter"),
    ("1998-Y", "fleet", None, 410.25, "check", "a year"),
    ("1996-Q1", "model", "PROMO", 365.0, "check", "matches every model that ends with the word"),
    ("1999-Q3", "model", "Brand#11 SMALL", 500.0, "check", "an exact name"),
    ("2050-Q1", "fleet", None, 1.0, "known_gap", "not in the data"),
)
REFERENCE_SCHEMA = "period string, scope string, model string, afr_pct double, status string, note string"
RECONCILE = """rec AS (
  SELECT p.period, p.scope, p.model, p.status, CAST(p.afr_pct AS DOUBLE) AS published_afr_pct, coalesce(f.afr_pct, m.afr_pct) AS our_afr_pct,
         round(coalesce(f.afr_pct, m.afr_pct) - CAST(p.afr_pct AS DOUBLE), 2) AS difference, CAST(CASE WHEN p.scope = 'model' THEN 0.01 ELSE 0.05 END AS DOUBLE) AS tolerance, p.note
  FROM ref p LEFT JOIN (SELECT year_quarter AS period, afr_pct FROM fq UNION ALL SELECT year || '-Y', afr_pct FROM fy) f ON p.scope = 'fleet' AND f.period = p.period
  LEFT JOIN mq m ON p.scope = 'model' AND m.year_quarter = p.period AND (m.model = p.model OR m.model LIKE '% ' || p.model))"""
REFERENCE_SQL = values_sql(REFERENCE, "ref", "period, scope, model, afr_pct, status, note")
RECONCILE_CTES = (PART_PANEL, MODEL_DAILY, PATTERNS_PP, dim_sql("pp"), VERDICTS, MODEL_QUARTER, QUARTERS, FLEET_QUARTER, FLEET_YEAR, REFERENCE_SQL, RECONCILE)


@query(with_sql("SELECT * FROM rec", *RECONCILE_CTES))
def reconcile_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = spark.createDataFrame(list(REFERENCE), REFERENCE_SCHEMA)
    quarters = afr_fleet_quarter(spark, sf_dir)
    return models.reconcile(reference, quarters, models.afr_fleet_year(quarters), afr_model_quarter(spark, sf_dir))


@query(with_sql(f"SELECT {YEAR_QUARTER} AS year_quarter, status, count(*) AS days FROM dv GROUP BY 1, 2", PART_PANEL, VERDICTS))
def day_status_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(models.model_daily(part_panel(spark, sf_dir))).groupBy(year_quarter(F.col("date")).alias("year_quarter"), "status").agg(F.count("*").alias("days"))
