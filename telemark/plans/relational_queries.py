"""Queries for the relational operators: joins, aggregates, windows, sets and scalar functions, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.telemetry import blank_to_null, layout_fingerprint, quarter_end, whole_number, year_quarter
from ..operators import bookkeeping, relational
from . import models
from .model_queries import MODEL_DAILY, YEAR_QUARTER, afr_sql, part_dim
from .panels import EVENT_DAYS, PART_PANEL, SUPPLIER_PANEL, event_days, part_panel, read, supplier_panel
from .registry import query, with_sql


@query(with_sql("SELECT s.serial_number, s.date, arg_max_null(r.realloc, r.date) AS past_value FROM sp s LEFT JOIN sp r ON r.serial_number = s.serial_number AND r.date BETWEEN s.date - 14 AND s.date - 7 GROUP BY 1, 2", SUPPLIER_PANEL))
def asof_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.latest_between(supplier_panel(spark, sf_dir).select("serial_number", "date", "realloc"), "serial_number", "date", "realloc", 14, 7)


@query(with_sql("SELECT a.serial_number, a.date, a.timeout, b.timeout AS previous FROM sp a LEFT JOIN sp b ON b.serial_number = a.serial_number AND b.date = a.date - 1", SUPPLIER_PANEL))
def prev_day_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.previous_day(supplier_panel(spark, sf_dir), "serial_number", "timeout")


FAILED = "f AS (SELECT serial_number, min(date) AS fail_date FROM pp WHERE failure GROUP BY 1)"


@query(with_sql("SELECT (SELECT count(*) FROM f) AS with_event, count(DISTINCT f.serial_number) AS seen_again FROM f JOIN pp ON pp.serial_number = f.serial_number AND pp.date > f.fail_date", PART_PANEL, FAILED))
def seen_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = part_panel(spark, sf_dir)
    return relational.seen_after(models.first_failures(panel), panel, "serial_number", "fail_date")


BOOT = "boot AS (SELECT serial_number FROM pp GROUP BY 1 HAVING count(slot_num) = 0)"


def never_in_a_slot(panel: DataFrame) -> DataFrame:
    return panel.groupBy("serial_number").agg(F.count("slot_num").alias("n")).filter("n = 0").select("serial_number")


@query(with_sql(f"SELECT (SELECT count(*) FROM boot) AS boot_drives, count(*) FILTER (failure) AS failures, count(*) AS drive_days, {afr_sql('count(*) FILTER (failure)', 'count(*)')} AS afr_pct FROM pp WHERE serial_number NOT IN (SELECT serial_number FROM boot)", PART_PANEL, BOOT))
def anti_boot(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = part_panel(spark, sf_dir)
    boot = never_in_a_slot(panel)
    rest = relational.except_keys(panel, boot, "serial_number").agg(F.count_if("failure").alias("failures"), F.count("*").alias("drive_days"))
    counted = boot.agg(F.count("*").alias("boot_drives")).crossJoin(F.broadcast(rest))  # one row each
    return counted.withColumn("afr_pct", models.afr_pct(F.col("failures"), F.col("drive_days")))


@query(with_sql("SELECT CASE WHEN capacity < 1000000000000 THEN 'under 1 TB' ELSE '1 TB or more' END AS size_class, count(*) AS drives, CAST(sum(failed) AS BIGINT) AS failed_drives FROM (SELECT serial_number, max(capacity_bytes) AS capacity, max(CAST(failure AS INT)) AS failed FROM pp GROUP BY 1 HAVING count(slot_num) = 0) GROUP BY 1", PART_PANEL))
def never_slot_size_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = part_panel(spark, sf_dir).groupBy("serial_number").agg(F.max("capacity_bytes").alias("capacity"), F.max(F.col("failure").cast("int")).alias("failed"), F.count("slot_num").alias("n"))
    size_class = F.when(F.col("capacity") < 1_000_000_000_000, "under 1 TB").otherwise("1 TB or more")
    return each.filter("n = 0").groupBy(size_class.alias("size_class")).agg(F.count("*").alias("drives"), F.sum("failed").alias("failed_drives"))


@query(with_sql("SELECT failure, count(*) AS rows, count(*) FILTER (slot_num IS NULL) AS no_slot FROM pp GROUP BY 1", PART_PANEL))
def failure_without_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_panel(spark, sf_dir).groupBy("failure").agg(F.count("*").alias("rows"), F.count_if(F.col("slot_num").isNull()).alias("no_slot"))


@query(with_sql("SELECT count(*) FILTER (c > 1) AS changing_capacity_bytes, count(*) FILTER (m > 1) AS changing_model, count(*) FILTER (s > 1) AS changing_slot_num FROM (SELECT serial_number, count(DISTINCT capacity_bytes) AS c, count(DISTINCT model) AS m, count(DISTINCT slot_num) AS s FROM pp GROUP BY 1)", PART_PANEL))
def attribute_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.unstable(part_panel(spark, sf_dir), "serial_number", ["capacity_bytes", "model", "slot_num"])


@query(with_sql(" UNION ALL ".join(f"SELECT '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls FROM pp" for c in ("serial_number", "date", "model", "capacity_bytes", "failure", "slot_num")), PART_PANEL))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.null_profile(part_panel(spark, sf_dir)).select("column", "rows", "nulls")


@query(with_sql("SELECT date, count(*) AS rows, count(DISTINCT serial_number) AS drives, count(*) - count(DISTINCT serial_number) AS duplicate_rows, count(*) FILTER (failure) AS failures, count(*) - count(slot_num) AS no_slot FROM pp GROUP BY 1", PART_PANEL))
def day_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    drives = F.count_distinct("serial_number")
    return part_panel(spark, sf_dir).groupBy("date").agg(
        F.count("*").alias("rows"), drives.alias("drives"), (F.count("*") - drives).alias("duplicate_rows"), F.count_if("failure").alias("failures"), (F.count("*") - F.count("slot_num")).alias("no_slot")
    )


@query(with_sql(f"SELECT 'all drives' AS scope, count(*) FILTER (failure) AS failures, count(*) AS drive_days, {afr_sql('count(*) FILTER (failure)', 'count(*)')} AS afr_pct FROM pp UNION ALL SELECT 'in a slot', count(*) FILTER (failure), count(*), {afr_sql('count(*) FILTER (failure)', 'count(*)')} FROM pp WHERE slot_num IS NOT NULL", PART_PANEL))
def afr_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scopes from one scan: each row goes to the scopes that it is in, and counters combine before the shuffle."""
    scopes = F.when(F.col("slot_num").isNotNull(), F.array(F.lit("all drives"), F.lit("in a slot"))).otherwise(F.array(F.lit("all drives")))
    counted = part_panel(spark, sf_dir).select(F.explode(scopes).alias("scope"), "failure").groupBy("scope").agg(F.count_if("failure").alias("failures"), F.count("*").alias("drive_days"))
    return counted.withColumn("afr_pct", models.afr_pct(F.col("failures"), F.col("drive_days")))


@query(with_sql("SELECT model, drive_days FROM (SELECT model, CAST(sum(drive_days) AS BIGINT) AS drive_days FROM md GROUP BY 1) ORDER BY drive_days DESC, model LIMIT 10", PART_PANEL, MODEL_DAILY))
def topk_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = part_panel(spark, sf_dir).groupBy("model").agg(F.count("*").alias("drive_days"))
    return relational.top(counted, 10, F.desc("drive_days"), F.col("model"))


@query(with_sql("SELECT date, row_count, round((row_count - lag(row_count) OVER (ORDER BY date)) / CAST(lag(row_count) OVER (ORDER BY date) AS DOUBLE) * 100, 6) AS change_pct FROM ed", EVENT_DAYS))
def pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.percent_change(event_days(spark, sf_dir), "row_count")


# The trio of benchmark queries: model by quarter, one device's history, one model by year.
@query(with_sql("SELECT model, count(*) AS drive_days, count(*) FILTER (failure) AS failures FROM pp WHERE date BETWEEN DATE '1998-04-01' AND DATE '1998-06-30' GROUP BY 1", PART_PANEL))
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarter = part_panel(spark, sf_dir).filter(F.col("date").between("1998-04-01", "1998-06-30"))
    return quarter.groupBy("model").agg(F.count("*").alias("drive_days"), F.count_if("failure").alias("failures"))


@query(with_sql("SELECT date, model, capacity_bytes, failure FROM pp WHERE serial_number = 77", PART_PANEL))
def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_panel(spark, sf_dir).filter("serial_number = 77").select("date", "model", "capacity_bytes", "failure")


@query(with_sql("SELECT CAST(year(date) AS INTEGER) AS yr, count(*) AS drive_days FROM pp WHERE model = 'Brand#11 SMALL' GROUP BY 1", PART_PANEL))
def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_panel(spark, sf_dir).filter(F.col("model") == "Brand#11 SMALL").groupBy(F.year("date").alias("yr")).agg(F.count("*").alias("drive_days"))


@query(with_sql("SELECT CAST(a.date AS DATE) AS date, 'missing' AS what FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM pp) a WHERE CAST(a.date AS DATE) NOT IN (SELECT date FROM pp) UNION ALL SELECT DISTINCT date, 'unexpected' FROM pp WHERE date > DATE '2001-06-30'", PART_PANEL))
def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without rows between the first and the last, and days after the expected end."""
    found = part_panel(spark, sf_dir).select("date").distinct()
    whole = found.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("date"))
    missing = whole.join(found, "date", "left_anti").select("date", F.lit("missing").alias("what"))
    return missing.union(found.filter(F.col("date") > "2001-06-30").select("date", F.lit("unexpected")))


# Layouts and versions of a small history.
LAYOUTS = (("1995-01-01", "date,serial,model"), ("1997-04-01", "date,serial,model,slot"), ("1999-07-01", "date,serial,slot,model,site"), ("2000-01-01", "date,serial,site,model"))


def layouts(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(LAYOUTS), "first_day string, header string")
    columns = F.split("header", ",")
    return rows.select(F.col("first_day").cast("date").alias("first_day"), columns.alias("columns"), layout_fingerprint(columns).alias("fingerprint"))


LAYOUT_VALUES = "lay(first_day, header) AS (VALUES " + ", ".join(f"(DATE '{d}', '{h}')" for d, h in LAYOUTS) + ")"
_DIFF = "array_to_string(list_sort(list_filter({a}, lambda x: NOT list_contains({b}, x))), ',')"


@query(with_sql(f"SELECT fingerprint, first_day, CAST(len(cols) AS INTEGER) AS column_count, CASE WHEN prev IS NULL THEN '' ELSE {_DIFF.format(a='cols', b='prev')} END AS added, CASE WHEN prev IS NULL THEN '' ELSE {_DIFF.format(a='prev', b='cols')} END AS removed FROM (SELECT first_day, string_split(header, ',') AS cols, lag(string_split(header, ',')) OVER (ORDER BY first_day) AS prev, substr(sha256(header), 1, 12) AS fingerprint FROM lay)", LAYOUT_VALUES))
def layout_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = lambda c: F.concat_ws(",", F.array_sort(c)).alias(c)
    return bookkeeping.layout_diff(layouts(spark)).select("fingerprint", "first_day", "column_count", spelled("added"), spelled("removed"))


VERSIONS = (
    ("a.zip", "a1", "2020-01-01 00:00:00", False, True), ("a.zip", "a2", "2020-02-01 00:00:00", False, True), ("a.zip", "a3", "2020-03-01 00:00:00", True, True),
    ("b.zip", "b1", "2020-01-05 00:00:00", True, True), ("b.zip", "b2", "2020-01-09 00:00:00", False, False), ("c.zip", "c1", "2020-01-07 00:00:00", True, True),
)
VERSION_VALUES = "ver(source, sha, stored_at, is_current, extracted) AS (VALUES " + ", ".join(f"('{a}', '{b}', TIMESTAMP '{c}', {d}, {e})" for a, b, c, d, e in VERSIONS) + ")"
DAYS = (("a.zip", "a2", "1996-01-01", "x"), ("a.zip", "a2", "1996-01-02", "y"), ("a.zip", "a3", "1996-01-01", "x"), ("a.zip", "a3", "1996-01-02", "z"), ("a.zip", "a3", "1996-01-03", "w"), ("b.zip", "b1", "1996-02-01", "v"), ("c.zip", "c1", "1996-01-03", "u"))
DAY_VALUES = "dy(source, sha, date, day_sha) AS (VALUES " + ", ".join(f"('{a}', '{b}', DATE '{c}', '{d}')" for a, b, c, d in DAYS) + ")"


def versions(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(VERSIONS), "source string, sha string, stored_at string, is_current boolean, extracted boolean")
    return rows.withColumn("stored_at", F.to_timestamp("stored_at"))


def version_days(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DAYS), "source string, sha string, date string, day_sha string").withColumn("date", F.col("date").cast("date"))


@query(with_sql("SELECT v.source, v.sha, v.is_current, CASE WHEN NOT v.is_current THEN coalesce((SELECT arg_min(l.sha, l.stored_at) FROM ver l WHERE l.source = v.source AND l.stored_at > v.stored_at), (SELECT max(c.sha) FROM ver c WHERE c.source = v.source AND c.is_current)) END AS superseded_by FROM ver v", VERSION_VALUES))
def version_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookkeeping.superseded(versions(spark)).select("source", "sha", "is_current", "superseded_by")


@query(with_sql("SELECT d.source, d.date, d.sha, d.day_sha, CASE WHEN p.day_sha IS NULL THEN 'new' WHEN p.day_sha = d.day_sha THEN 'same' ELSE 'changed' END AS change FROM dy d JOIN ver v ON v.source = d.source AND v.sha = d.sha AND v.is_current LEFT JOIN (SELECT source, arg_max(sha, stored_at) AS sha FROM ver WHERE NOT is_current AND extracted GROUP BY 1) o ON o.source = d.source LEFT JOIN dy p ON p.source = o.source AND p.sha = o.sha AND p.date = d.date", VERSION_VALUES, DAY_VALUES))
def version_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookkeeping.day_changes(version_days(spark), versions(spark))


@query(with_sql("SELECT d.date, count(*) AS sources FROM dy d JOIN ver v ON v.source = d.source AND v.sha = d.sha AND v.is_current GROUP BY 1 HAVING count(*) > 1", VERSION_VALUES, DAY_VALUES))
def source_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = version_days(spark).join(versions(spark).filter("is_current").select("source", "sha"), ["source", "sha"], "left_semi")
    return bookkeeping.clashes(current)


@query(with_sql("SELECT serial_number, date, model, NULL AS slot_num FROM pp WHERE date < DATE '1998-07-01' UNION ALL SELECT serial_number, date, NULL, slot_num FROM pp WHERE date >= DATE '1998-07-01'", PART_PANEL))
def union_missing_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, in two layouts that part at one date."""
    panel = part_panel(spark, sf_dir)
    old = panel.filter(F.col("date") < "1998-07-01").select("serial_number", "date", "model")
    return old.unionByName(panel.filter(F.col("date") >= "1998-07-01").select("slot_num", "serial_number", "date"), allowMissingColumns=True)


@query(with_sql("SELECT DISTINCT model, capacity_bytes FROM pp WHERE model LIKE '%PROMO' AND capacity_bytes BETWEEN 1000000000000 AND 2000000000000", PART_PANEL))
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = part_panel(spark, sf_dir).filter(F.col("model").like("%PROMO") & F.col("capacity_bytes").between(1_000_000_000_000, 2_000_000_000_000))
    return kept.select("model", "capacity_bytes").distinct()


@query(with_sql(f"SELECT DISTINCT date, {YEAR_QUARTER} AS year_quarter, CAST(date_trunc('quarter', date) AS DATE) AS quarter_start, CAST(last_day(date_trunc('quarter', date) + INTERVAL 2 MONTH) AS DATE) AS quarter_end, date + 30 AS in_30_days, CAST(date_diff('day', DATE '1995-01-01', date) AS INTEGER) AS day_number, CAST(year(date) AS INTEGER) AS y, CAST(month(date) AS INTEGER) AS m FROM pp", PART_PANEL))
def period_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("date")
    return part_panel(spark, sf_dir).select("date").distinct().select(
        "date", year_quarter(day).alias("year_quarter"), F.trunc(day, "quarter").alias("quarter_start"), quarter_end(day).alias("quarter_end"), F.date_add(day, 30).alias("in_30_days"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("day_number"), F.year(day).alias("y"), F.month(day).alias("m"),
    )


@query("SELECT p_partkey, lower(trim(p_name)) AS name, length(p_name) AS name_length, substr(p_brand, 1, 5) AS brand, regexp_extract(p_brand, '[0-9]+') AS digits, TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS number, p_brand LIKE 'Brand#1%' AS ones, sha256(p_name) AS name_sha, nullif(trim(p_type), '') AS kind, p_partkey // 24 AS whole, round(p_retailprice, 1) AS price, abs(p_size - 25) AS off FROM part")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.regexp_extract("p_brand", "[0-9]+", 0)
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.lower(F.trim("p_name")).alias("name"), F.length("p_name").cast("bigint").alias("name_length"), F.substring("p_brand", 1, 5).alias("brand"), digits.alias("digits"),
        whole_number(digits, "int").alias("number"), F.col("p_brand").like("Brand#1%").alias("ones"), F.sha2("p_name", 256).alias("name_sha"), blank_to_null(F.col("p_type")).alias("kind"),
        F.expr("p_partkey div 24").alias("whole"), F.round("p_retailprice", 1).alias("price"), F.abs(F.col("p_size") - 25).alias("off"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.absent') AS VARCHAR) AS absent FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.get_json_object("props", "$.absent").alias("absent"))


@query("SELECT user_id, note, count(*) AS n FROM (SELECT user_id, unnest(list_filter([CASE WHEN value < 5 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'error' END, CASE WHEN event_id % 7 = 0 THEN 'seventh' END], lambda x: x IS NOT NULL)) AS note FROM events) GROUP BY 1, 2")
def array_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = F.array_compact(F.array(F.when(F.col("value") < 5, "low"), F.when(F.col("event_type") == "error", "error"), F.when(F.col("event_id") % 7 == 0, "seventh")))
    return read(spark, sf_dir, "events").select("user_id", F.explode(notes).alias("note")).groupBy("user_id", "note").agg(F.count("*").alias("n"))


@query(with_sql("SELECT CAST(median(row_count) AS DOUBLE) AS middle, min(row_count) AS low, max(row_count) AS high, round(avg(row_count), 4) AS mean, count(*) AS days, count(*) FILTER (row_count < 320) AS small FROM ed", EVENT_DAYS))
def size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("row_count")
    return event_days(spark, sf_dir).agg(F.median(n).alias("middle"), F.min(n).alias("low"), F.max(n).alias("high"), F.round(F.avg(n), 4).alias("mean"), F.count("*").alias("days"), F.count_if(n < 320).alias("small"))


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2")
def status_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))


@query("SELECT user_id, max(ts) AS last_ts, arg_max(event_type, (ts, event_id)) AS last_type, arg_min(event_type, (ts, event_id)) AS first_type, bool_or(value > 90) AS any_high, count(DISTINCT event_type) AS kinds, max(value) FILTER (event_type = 'click') AS top_click FROM events GROUP BY 1")
def last_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("ts", "event_id")
    return read(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("ts").alias("last_ts"), F.max_by("event_type", order).alias("last_type"), F.min_by("event_type", order).alias("first_type"), F.bool_or(F.col("value") > 90).alias("any_high"),
        F.count_distinct("event_type").alias("kinds"), F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("top_click"),
    )


@query(with_sql("SELECT * FROM (SELECT serial_number, date, failure, row_number() OVER (PARTITION BY serial_number ORDER BY date, capacity_bytes, failure, slot_num NULLS FIRST) AS n, count(*) OVER (PARTITION BY serial_number, date) AS copies FROM pp) WHERE n <= 2 OR copies > 1", PART_PANEL))
def ranked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = Window.partitionBy("serial_number")
    rank = F.row_number().over(device.orderBy("date", "capacity_bytes", "failure", F.asc_nulls_first("slot_num")))
    rows = part_panel(spark, sf_dir).select("serial_number", "date", "failure", rank.cast("bigint").alias("n"), F.count("*").over(Window.partitionBy("serial_number", "date")).alias("copies"))
    return rows.filter("n <= 2 OR copies > 1")


@query(with_sql(f"SELECT dim.model AS model, {YEAR_QUARTER} AS year_quarter, CAST(sum(md.failures) AS BIGINT) AS failures FROM md LEFT JOIN (SELECT model, count(*) AS n FROM pp WHERE model LIKE '%SMALL' GROUP BY 1) dim ON dim.model = md.model GROUP BY 1, 2", PART_PANEL, MODEL_DAILY))
def left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = part_dim(spark, sf_dir).filter(F.col("model").like("%SMALL")).select("model", F.col("model").alias("known"))
    daily = models.model_daily(part_panel(spark, sf_dir)).join(dim, "model", "left")
    return daily.groupBy(F.col("known").alias("model"), year_quarter(F.col("date")).alias("year_quarter")).agg(F.sum("failures").alias("failures"))
