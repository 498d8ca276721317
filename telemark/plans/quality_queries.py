"""Queries for cast, dedupe, day counts, baseline, verdicts and data assertions, each with its oracle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import DEFAULT, Baseline, Limits
from ..functions.telemetry import year_quarter
from ..operators import audit
from ..operators.cast import FILE_DATE, REASONS, SOURCE_FILE, WARNINGS, cast_layout
from ..operators.dedupe import dedupe, versions
from ..operators.relational import latest_by_bucket
from . import model_queries, models
from .assertions import accepted_values, not_null, unique, within_tolerance
from .model_queries import DEVICE_FAILURE, FEATURE_DAY, HEALTH, MODEL_DAILY, MODEL_DAILY_SP, PATTERNS_PP, PATTERNS_SP, RECONCILE_CTES, VERDICTS, dim_sql
from .panels import EVENT_DAYS, PART_PANEL, SUPPLIER_PANEL, event_days, part_panel, read, supplier_panel
from .registry import query, with_sql


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a text file would hold them, with defects by rule."""
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity", F.col("l_shipdate").cast("date").alias("day"))
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("k", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
    every = lambda n: F.col("k") % n == 0
    return rows.select(
        F.when(every(50), "July 1").when(every(41), F.date_format("day", "M/d/yy")).when(every(43), F.date_format(F.date_add("day", 1), "yyyy-MM-dd")).when(every(59), "2001-13-45").otherwise(F.date_format("day", "yyyy-MM-dd")).alias("date"),
        F.when(every(97), "  ").otherwise(F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" "))).alias("serial_number"),
        F.when(every(89), "2").when(~every(83), F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49), "1").otherwise("0")).alias("failure"),
        F.when(every(31), "").otherwise(F.concat_ws(" ", "p_brand", "p_type")).alias("model"),
        F.when(every(29), "4.00079E+12").when(every(37), "-1").when(every(53), "99999999999999999999").otherwise((F.col("p_size").cast("bigint") * 100_000_000_000).cast("string")).alias("capacity_bytes"),
        F.lpad((F.col("l_linenumber") * 12).cast("string"), 4, "0").alias("pod_slot_num"),
        F.when(every(47), "maybe").when(every(3), "True").otherwise("false").alias("is_legacy_format"),
        F.when(~every(11), F.concat(F.lit("dc"), (F.col("l_suppkey") % 3).cast("string"))).alias("datacenter"),
        F.lit("ignored").alias("unknown_column"),
        F.col("day").alias(FILE_DATE),
        F.concat(F.lit("file-"), (F.col("l_suppkey") % 4).cast("string")).alias(SOURCE_FILE),
    )


TEXT = """tx AS (
  SELECT d AS file_date, 'file-' || (l_suppkey % 4) AS source_file, trim(serial) AS serial, failure, nullif(trim(model), '') AS model, cap, slot, legacy, dc,
         CASE WHEN regexp_matches(dt, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN TRY_CAST(dt AS DATE)
              WHEN regexp_matches(dt, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$') THEN make_date(2000 + CAST(split_part(dt, '/', 3) AS INT), CAST(split_part(dt, '/', 1) AS INT), CAST(split_part(dt, '/', 2) AS INT)) END AS parsed
  FROM (SELECT *, CAST(l_shipdate AS DATE) AS d, l_orderkey * 7 + l_linenumber AS k,
          CASE WHEN k % 50 = 0 THEN 'July 1' WHEN k % 41 = 0 THEN strftime(d, '%-m/%-d/%y') WHEN k % 43 = 0 THEN strftime(d + 1, '%Y-%m-%d') WHEN k % 59 = 0 THEN '2001-13-45' ELSE strftime(d, '%Y-%m-%d') END AS dt,
          CASE WHEN k % 97 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS serial,
          CASE WHEN k % 89 = 0 THEN '2' WHEN k % 83 = 0 THEN NULL WHEN l_returnflag = 'R' AND l_quantity >= 49 THEN '1' ELSE '0' END AS failure,
          CASE WHEN k % 31 = 0 THEN '' ELSE p_brand || ' ' || p_type END AS model,
          CASE WHEN k % 29 = 0 THEN '4.00079E+12' WHEN k % 37 = 0 THEN '-1' WHEN k % 53 = 0 THEN '99999999999999999999' ELSE CAST(CAST(p_size AS BIGINT) * 100000000000 AS VARCHAR) END AS cap,
          l_linenumber * 12 AS slot, CASE WHEN k % 47 = 0 THEN 'maybe' WHEN k % 3 = 0 THEN 'True' ELSE 'false' END AS legacy, CASE WHEN k % 11 <> 0 THEN 'dc' || (l_suppkey % 3) END AS dc
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""
REASONS_SQL = """rs AS (SELECT *, array_to_string(list_filter([CASE WHEN serial = '' THEN 'serial_number empty' END, CASE WHEN failure IS NULL OR failure NOT IN ('0', '1') THEN 'failure not 0 or 1' END,
  CASE WHEN parsed IS NULL THEN 'date unreadable' END, CASE WHEN parsed <> file_date THEN 'date differs from the file name' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM tx)"""
CAST = """SELECT file_date AS date, serial AS serial_number, failure = '1' AS failure, model,
  CASE WHEN regexp_matches(cap, '^-?[0-9]+$') AND TRY_CAST(cap AS BIGINT) >= 1 THEN TRY_CAST(cap AS BIGINT) END AS capacity_bytes, CAST(slot AS INTEGER) AS pod_slot_num,
  CASE lower(legacy) WHEN 'true' THEN true WHEN 'false' THEN false END AS is_legacy_format, dc AS datacenter,
  array_to_string(list_filter([CASE WHEN model IS NULL THEN 'model: blank' END, CASE WHEN NOT regexp_matches(cap, '^-?[0-9]+$') OR TRY_CAST(cap AS BIGINT) IS NULL THEN 'capacity_bytes: unreadable' END,
    CASE WHEN regexp_matches(cap, '^-?[0-9]+$') AND TRY_CAST(cap AS BIGINT) < 1 THEN 'capacity_bytes: impossible' END, CASE WHEN slot > 59 THEN 'pod_slot_num: outside expected range' END,
    CASE WHEN lower(legacy) NOT IN ('true', 'false') THEN 'is_legacy_format: unreadable' END, CASE WHEN dc IS NULL THEN 'datacenter: blank' END], lambda x: x IS NOT NULL), '; ') AS notes, source_file
FROM rs WHERE reasons = ''"""


@query(with_sql(CAST, TEXT, REASONS_SQL))
def cast_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = cast_layout(text_rows(spark, sf_dir), DEFAULT)
    return good.select("date", "serial_number", "failure", "model", "capacity_bytes", "pod_slot_num", "is_legacy_format", "datacenter", F.concat_ws("; ", WARNINGS).alias("notes"), F.col(SOURCE_FILE).alias("source_file"))


@query(with_sql("SELECT file_date, source_file, reasons, count(*) AS n FROM rs WHERE reasons <> '' GROUP BY 1, 2, 3", TEXT, REASONS_SQL))
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = cast_layout(text_rows(spark, sf_dir), DEFAULT)
    return bad.groupBy(F.col(FILE_DATE).alias("file_date"), F.col(SOURCE_FILE).alias("source_file"), F.concat_ws("; ", REASONS).alias("reasons")).agg(F.count("*").alias("n"))


@query(with_sql(f"SELECT w AS warning, count(*) AS n FROM (SELECT unnest(string_split(notes, '; ')) AS w FROM ({CAST}) WHERE notes <> '') GROUP BY 1", TEXT, REASONS_SQL))
def cast_detail_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = cast_layout(text_rows(spark, sf_dir), DEFAULT)
    return good.select(F.explode(WARNINGS).alias("warning")).groupBy("warning").agg(F.count("*").alias("n"))


def copied_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part panel with exact copies of each tenth part from a second file."""
    sources = F.when(F.col("serial_number") % 10 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    copied = part_panel(spark, sf_dir).select("*", F.explode(sources).alias(SOURCE_FILE))
    return copied.withColumn("serial_number", F.col("serial_number").cast("string")).withColumn(WARNINGS, F.expr("cast(array() as array<string>)"))


COPIED = "cp AS (SELECT CAST(serial_number AS VARCHAR) AS serial_number, date, model, capacity_bytes, failure, slot_num, 'a' AS src FROM pp UNION ALL SELECT CAST(serial_number AS VARCHAR), date, model, capacity_bytes, failure, slot_num, 'b' FROM pp WHERE serial_number % 10 = 0)"
VERSIONED = "vs AS (SELECT *, count(*) OVER (PARTITION BY date, serial_number) AS versions FROM (SELECT serial_number, date, model, capacity_bytes, failure, slot_num, min(src) AS src, count(*) AS copies FROM cp GROUP BY ALL))"


@query(with_sql("SELECT serial_number, date, model, capacity_bytes, failure, slot_num, src AS source_file, CASE WHEN copies > 1 THEN 'exact duplicate removed' ELSE '' END AS notes FROM vs WHERE versions = 1", PART_PANEL, COPIED, VERSIONED.replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5, 6")))
def dedupe_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = dedupe(copied_rows(spark, sf_dir))
    return kept.select("serial_number", "date", "model", "capacity_bytes", "failure", "slot_num", F.col(SOURCE_FILE).alias("source_file"), F.concat_ws("; ", WARNINGS).alias("notes"))


@query(with_sql("SELECT date AS file_date, src AS source_file, serial_number AS serial, failure, count(*) AS n FROM vs WHERE versions > 1 GROUP BY 1, 2, 3, 4", PART_PANEL, COPIED, VERSIONED.replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5, 6")))
def dedupe_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, conflicts = dedupe(copied_rows(spark, sf_dir))
    failed = F.get_json_object("raw", "$.failure").cast("boolean")
    return conflicts.groupBy(F.col(FILE_DATE).alias("file_date"), F.col(SOURCE_FILE).alias("source_file"), F.get_json_object("raw", "$.serial_number").alias("serial"), failed.alias("failure")).agg(F.count("*").alias("n"))


VERSION_CTES = (PART_PANEL, COPIED, VERSIONED.replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5, 6"))
COUNTS = """dc AS (
  SELECT d.date, coalesce(g.n, 0) AS cast_good, coalesce(q.n, 0) AS cast_quarantined, coalesce(c.n, 0) AS conflict_rows, coalesce(c.m, 0) AS conflict_drives, coalesce(k.n, 0) AS silver_rows
  FROM (SELECT DISTINCT date FROM cp UNION SELECT DATE '2020-02-02') d LEFT JOIN (SELECT date, count(*) AS n FROM cp GROUP BY 1) g USING (date)
  LEFT JOIN (SELECT date, count(*) AS n FROM cp WHERE capacity_bytes = 100000000000 AND src = 'b' GROUP BY 1) q USING (date)
  LEFT JOIN (SELECT date, count(*) AS n, count(DISTINCT serial_number) AS m FROM vs WHERE versions > 1 GROUP BY 1) c USING (date)
  LEFT JOIN (SELECT date, count(*) AS n FROM vs WHERE versions = 1 GROUP BY 1) k USING (date))"""


def counted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copied_rows(spark, sf_dir)
    set_aside = rows.filter((F.col("capacity_bytes") == 100_000_000_000) & (F.col(SOURCE_FILE) == "b")).withColumnRenamed("date", FILE_DATE)
    return audit.day_counts(versions(rows), set_aside, spark.createDataFrame([(date(2020, 2, 2),)], "date date"))


@query(with_sql("SELECT date, count(DISTINCT serial_number) AS devices FROM vs WHERE versions > 1 GROUP BY 1", *VERSION_CTES))
def conflict_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.conflict_devices(dedupe(copied_rows(spark, sf_dir))[1])


@query(with_sql("SELECT * FROM dc", *VERSION_CTES, COUNTS))
def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_days(spark, sf_dir)


def baseline_sql(days: str, rules: Baseline) -> str:
    """The recursion over the calendar, a row at a time; the state is the list of the last normal days."""
    usable = "(c.there AND c.status <> 'empty' AND c.row_count <> 0)"
    base = f"CASE WHEN {usable} AND len(r.normal) > 0 THEN CAST(list_aggregate(r.normal, 'median') AS DOUBLE) END"
    partial = f"coalesce({usable} AND len(r.normal) > 0 AND c.row_count < {rules.partial_below} * CAST(list_aggregate(r.normal, 'median') AS DOUBLE), false)"
    return f"""cal AS (SELECT row_number() OVER (ORDER BY g.date) AS n, g.date, d.row_count, d.status, d.date IS NOT NULL AS there
  FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {days}) g LEFT JOIN {days} d ON d.date = g.date),
walk(n, date, bronze_rows, baseline, change, partial, usable, normal) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS DATE), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), false, false, CAST([] AS BIGINT[])
  UNION ALL
  SELECT c.n, c.date, c.row_count, {base}, round(c.row_count / {base} - 1, 4), {partial}, coalesce({usable}, false),
         CASE WHEN coalesce({usable}, false) AND NOT {partial} THEN list_slice(list_append(r.normal, c.row_count), -{rules.window}, -1) ELSE r.normal END
  FROM walk r JOIN cal c ON c.n = r.n + 1),
sc AS (SELECT w.date, w.bronze_rows, w.baseline, w.change, w.partial, CASE WHEN w.bronze_rows IS NULL THEN 'missing' WHEN NOT w.usable THEN 'empty' WHEN w.partial THEN 'partial'
  WHEN abs(w.bronze_rows / w.baseline - 1) > {rules.warn_beyond} THEN 'unusual' END AS note FROM walk w WHERE w.n > 0)"""


DAY_FILES = "df0 AS (SELECT date, CASE WHEN day(date) % 11 = 0 THEN 0 WHEN day(date) % 7 = 0 THEN row_count // 2 ELSE row_count END AS row_count, CASE WHEN day(date) = 5 THEN 'empty' ELSE 'ok' END AS status FROM ed WHERE day(date) <> 17)"


@query(with_sql("SELECT * FROM sc", EVENT_DAYS, DAY_FILES, baseline_sql("df0", Baseline())))
def row_count_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, n = F.dayofmonth("date"), F.col("row_count")
    days = event_days(spark, sf_dir).filter(day != 17).select(
        "date", F.when(day % 11 == 0, 0).when(day % 7 == 0, F.floor(n / 2)).otherwise(n).cast("bigint").alias("row_count"), F.when(day == 5, "empty").otherwise("ok").alias("status")
    )
    return audit.source_checks(days)


LOOSE = Baseline(window=7, partial_below=0.5, warn_beyond=0.6)
TIGHT = Limits(quarantined_share=0.05, conflicting_devices=1)
BRONZE = "bz AS (SELECT date, cast_good + cast_quarantined + CASE WHEN date_diff('day', DATE '1995-01-01', date) % 101 = 0 THEN 1 ELSE 0 END AS row_count, 'ok' AS status FROM dc WHERE date < DATE '2010-01-01')"
JUDGED = f"""SELECT date, CASE WHEN lost OR heavy OR conflict_drives > {TIGHT.conflicting_devices} THEN 'blocked' WHEN partial THEN 'partial' WHEN note IS NOT NULL OR quarantined > 0 OR copies <> 0 THEN 'warn' ELSE 'ok' END AS status,
  bronze AS bronze_rows, silver_rows, quarantined AS quarantined_rows, copies AS exact_copies, baseline AS usual_rows
FROM (SELECT *, cast_good + cast_quarantined <> bronze AS lost, quarantined > 0 AND quarantined / CAST(bronze AS DOUBLE) > {TIGHT.quarantined_share} AS heavy
      FROM (SELECT dc.*, sc.note, sc.partial, sc.baseline, coalesce(sc.bronze_rows, 0) AS bronze, cast_quarantined + conflict_rows AS quarantined, cast_good - conflict_rows - silver_rows AS copies FROM dc JOIN sc USING (date)))"""


@query(with_sql(JUDGED, *VERSION_CTES, COUNTS, BRONZE, baseline_sql("bz", LOOSE)))
def judge_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts go along with the series that the baseline folds, so rows are read once."""
    counts = counted_days(spark, sf_dir).filter(F.col("date") < "2010-01-01")
    extra = F.when(F.datediff("date", F.lit("1995-01-01").cast("date")) % 101 == 0, 1).otherwise(0)
    days = counts.select("*", (F.col("cast_good") + F.col("cast_quarantined") + extra).alias("row_count"), F.lit("ok").alias("status"))
    checked = audit.source_checks(days, LOOSE, carry=audit.COUNTERS).filter(F.col("bronze_rows").isNotNull())
    return audit.judge(checked, TIGHT).drop("blocks", "warnings")


@query(with_sql("SELECT date, 'warn' AS status, row_count AS bronze_rows, CAST(0 AS BIGINT) AS silver_rows FROM ed WHERE date IN (DATE '2024-01-10', DATE '2024-01-12')", EVENT_DAYS))
def defect_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = {date(2024, 1, 10): "a copy of the next day", date(2024, 1, 12): "readings are missing", date(2031, 1, 1): "not in the data"}
    return audit.defect_verdicts(event_days(spark, sf_dir), listed).select("date", "status", "bronze_rows", "silver_rows")


CONTINUITY = """SELECT date, count(*) FILTER (changed) AS changed_devices, count(*) FILTER (failed) AS reappeared_devices, greatest(count(*) FILTER (changed), count(*) FILTER (failed)) > 10 AS too_many
FROM (SELECT date, coalesce(pending <> lag(pending) OVER w, false) OR coalesce(model <> lag(model) OVER w, false) AS changed,
             coalesce(max(CAST(failure AS INT)) OVER (PARTITION BY serial_number ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1, false) AS failed
      FROM sp WINDOW w AS (PARTITION BY serial_number ORDER BY date)) GROUP BY 1"""


@query(with_sql(CONTINUITY, SUPPLIER_PANEL))
def continuity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.continuity(supplier_panel(spark, sf_dir), ("pending", "model"), Limits(conflicting_devices=10))


# Data assertions: a row is a failure. Oracles return the same rows, for most of them none.
DIM_CTES = (PART_PANEL, PATTERNS_PP, dim_sql("pp"))


@query(with_sql("SELECT 'model' AS column, CAST(model AS VARCHAR) AS value, 'null' AS problem FROM dim WHERE model IS NULL UNION ALL SELECT 'manufacturer', manufacturer, 'not accepted' FROM (SELECT DISTINCT manufacturer FROM dim WHERE manufacturer NOT IN ('Alder', 'Birch', 'Cedar'))", *DIM_CTES))
def assert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = model_queries.part_dim(spark, sf_dir)
    return not_null(dim, "model").union(unique(dim, "model")).union(accepted_values(dim, "manufacturer", ("Alder", "Birch", "Cedar")))


@query(with_sql("SELECT serial_number, date, count(*) AS n FROM pp GROUP BY 1, 2 HAVING count(*) > 1", PART_PANEL))
def assert_one_row_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_panel(spark, sf_dir).groupBy("serial_number", "date").agg(F.count("*").alias("n")).filter("n > 1")


@query(with_sql("SELECT h.date, h.drives, f.drives AS fleet_drives FROM (SELECT date, CAST(sum(drives) AS BIGINT) AS drives, CAST(sum(failures) AS BIGINT) AS failures FROM fh GROUP BY 1) h JOIN (SELECT date, count(*) AS drives, count(*) FILTER (failure) AS failures FROM sp GROUP BY 1) f USING (date) WHERE h.drives <> f.drives OR h.failures <> f.failures", SUPPLIER_PANEL, MODEL_DAILY_SP, PATTERNS_SP, dim_sql("sp"), HEALTH))
def assert_health_matches_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = model_queries.fleet_health_30d(spark, sf_dir).groupBy("date").agg(F.sum("drives").alias("drives"), F.sum("failures").alias("failures"))
    fleet = models.fleet_daily(supplier_panel(spark, sf_dir)).select("date", F.col("drives").alias("fleet_drives"), F.col("failures").alias("fleet_failures"))
    return health.join(fleet, "date").filter("drives <> fleet_drives OR failures <> fleet_failures").select("date", "drives", "fleet_drives")


@query(with_sql("SELECT m.d AS drive_days, f.d AS fleet_drive_days FROM (SELECT CAST(sum(drive_days) AS BIGINT) AS d, CAST(sum(failures) AS BIGINT) AS x FROM md) m CROSS JOIN (SELECT count(*) AS d, count(*) FILTER (failure) AS x FROM pp) f WHERE m.d <> f.d OR m.x <> f.x", PART_PANEL, MODEL_DAILY))
def assert_totals_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = part_panel(spark, sf_dir)
    mart = models.model_daily(panel).agg(F.sum("drive_days").alias("drive_days"), F.sum("failures").alias("failures"))
    fleet = models.fleet_daily(panel).agg(F.sum("drives").alias("fleet_drive_days"), F.sum("failures").alias("fleet_failures"))
    return mart.crossJoin(F.broadcast(fleet)).filter("drive_days <> fleet_drive_days OR failures <> fleet_failures").select("drive_days", "fleet_drive_days")  # one row each


@query(with_sql("SELECT f.date, f.drives, d.silver_rows FROM (SELECT date, count(*) AS drives FROM pp GROUP BY 1) f JOIN dv d USING (date) WHERE f.drives <> d.silver_rows", PART_PANEL, VERDICTS))
def assert_days_match_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = part_panel(spark, sf_dir)
    return models.fleet_daily(panel).join(model_queries.verdicts(models.model_daily(panel)).select("date", "silver_rows"), "date").filter("drives <> silver_rows").select("date", "drives", "silver_rows")


LEAK = """SELECT f.serial_number, f.date FROM fd f LEFT JOIN df x ON x.serial_number = f.serial_number WHERE f.date >= x.fail_date
  OR (f.label_fail_30d = 1 AND NOT coalesce(x.fail_date > f.date AND x.fail_date <= f.date + 30, false)) OR (f.label_fail_30d = 0 AND coalesce(x.fail_date > f.date AND x.fail_date <= f.date + 30, false))
  OR (f.label_fail_30d = 0 AND f.date + 30 > (SELECT max(date) FROM sp))"""


@query(with_sql(LEAK, *FEATURE_DAY, DEVICE_FAILURE[-1]))
def assert_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row on or after the failure; labels agree with the failure table; unknown futures have no label."""
    failures = model_queries.device_failure(spark, sf_dir).select("serial_number", "fail_date")
    last = supplier_panel(spark, sf_dir).agg(F.max("date").alias("data_end"))
    soon = F.coalesce((F.col("fail_date") > F.col("date")) & (F.col("fail_date") <= F.date_add("date", 30)), F.lit(False))
    label = F.col("label_fail_30d")
    wrong = (F.col("date") >= F.col("fail_date")) | ((label == 1) & ~soon) | ((label == 0) & soon) | ((label == 0) & (F.date_add("date", 30) > F.col("data_end")))
    rows = model_queries.feat_drive_day(spark, sf_dir).join(failures, "serial_number", "left").crossJoin(F.broadcast(last))  # one row
    return rows.filter(wrong).select("serial_number", "date")


PAST_ONLY = "SELECT f.serial_number, f.date FROM fd f LEFT JOIN sp t ON t.serial_number = f.serial_number AND t.date = f.date LEFT JOIN (SELECT s.serial_number, s.date, arg_max_null(r.realloc, r.date) AS v FROM sp s JOIN sp r ON r.serial_number = s.serial_number AND r.date BETWEEN s.date - 14 AND s.date - 7 GROUP BY 1, 2) p ON p.serial_number = f.serial_number AND p.date = f.date WHERE f.realloc IS DISTINCT FROM t.realloc OR f.realloc_7d IS DISTINCT FROM (t.realloc - p.v)"


@query(with_sql(PAST_ONLY, *FEATURE_DAY))
def assert_past_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-back features recomputed by a join of buckets instead of windows: rows that disagree."""
    panel = supplier_panel(spark, sf_dir).select("serial_number", "date", "realloc")
    features = model_queries.feat_drive_day(spark, sf_dir).select("serial_number", "date", F.col("realloc").alias("f_now"), "realloc_7d")
    past = latest_by_bucket(panel, "serial_number", "date", "realloc", 14, 7)
    rows = features.join(panel, ["serial_number", "date"], "left").join(past, ["serial_number", "date"], "left")
    agree = F.col("f_now").eqNullSafe(F.col("realloc")) & F.col("realloc_7d").eqNullSafe(F.col("realloc") - F.col("past_value"))
    return rows.filter(~agree).select("serial_number", "date")


@query(with_sql("SELECT o.n AS ours, s.n AS silver FROM (SELECT count(*) AS n FROM df) o CROSS JOIN (SELECT count(DISTINCT serial_number) AS n FROM sp WHERE failure) s WHERE o.n <> s.n", *DEVICE_FAILURE))
def assert_failures_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = model_queries.device_failure(spark, sf_dir).agg(F.count("*").alias("ours"))
    silver = supplier_panel(spark, sf_dir).filter("failure").agg(F.count_distinct("serial_number").alias("silver"))
    return ours.crossJoin(F.broadcast(silver)).filter("ours <> silver")  # one row each


@query(with_sql("SELECT model, drive_days FROM dim WHERE manufacturer = 'Unknown' AND model NOT IN ('Brand#3 SMALL')", *DIM_CTES))
def assert_no_new_unknowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_queries.part_dim(spark, sf_dir).filter((F.col("manufacturer") == "Unknown") & ~F.col("model").isin("Brand#3 SMALL")).select("model", "drive_days")


@query(with_sql("SELECT period, scope, model, our_afr_pct, difference FROM rec WHERE status = 'check' AND (our_afr_pct IS NULL OR abs(difference) > tolerance)", *RECONCILE_CTES))
def assert_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return within_tolerance(model_queries.reconcile_reference(spark, sf_dir)).select("period", "scope", "model", "our_afr_pct", "difference")


@query(with_sql("SELECT CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR) AS year_quarter, model, count(*) AS copies FROM (SELECT DISTINCT CAST(date_trunc('quarter', date) AS DATE) AS date, model FROM md) GROUP BY 1, 2 HAVING count(*) > 1", PART_PANEL, MODEL_DAILY))
def assert_one_row_per_model_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = models.model_daily(part_panel(spark, sf_dir)).select(year_quarter(F.col("date")).alias("year_quarter"), "model").distinct()
    return rows.groupBy("year_quarter", "model").agg(F.count("*").alias("copies")).filter("copies > 1")
