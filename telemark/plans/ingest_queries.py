"""Queries for sources, archives, the load and the control plane: each works on files that it makes from the driver's tables."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections import defaultdict
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import DEFAULT
from ..functions.quarters import Quarter, archive_days
from ..operators import audit
from ..operators.cast import FILE_DATE, cast_all
from ..sources import archives, files
from ..sources.scratch import shared_folder, write_text
from ..sources.snapshots import Lake, PublishError, publish
from . import alarms, models
from . import load as loading
from .model_queries import ERAS, FLEET_QUARTER, QUARTERS, YEAR_QUARTER
from .panels import PART_PANEL, part_panel, read
from .quality_queries import REASONS_SQL, TEXT, text_rows
from .registry import query, with_sql
from .runner import ModelGraph, ScanTooLarge, next_target, run_stages, scan_guard

KINDS = "ek AS (SELECT CAST(ts AS DATE) AS date, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2)"


def kinds(spark: SparkSession, sf_dir: str) -> dict[date, list[tuple[str, int]]]:
    """Rows per day and kind of event: small, and what the daily files below hold."""
    found = defaultdict(list)
    counted = read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("date"), "event_type").agg(F.count("*").alias("n"))
    for r in counted.orderBy("date", "event_type").collect():
        found[r["date"]].append((r["event_type"], r["n"]))
    return found


def daily_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Days as CSV files of three layouts, by the day of the month: a folder, and (date, header_fingerprint, path)."""
    root, rows = shared_folder(spark, "days"), []
    for day, counted in kinds(spark, sf_dir).items():
        header = (("date", "kind", "n"), ("n", "date", "kind"), ("date", "kind", "n", "note"))[day.day % 3]
        lines = [",".join({"date": str(day), "kind": k, "n": str(n), "note": f"{k}!"}[c] for c in header) for k, n in counted]
        path = f"{root}/{day}.csv"
        write_text(spark, path, "\n".join([",".join(header), *lines]) + "\n")
        rows.append((day, files.Header(header).fingerprint, path))
    return root, spark.createDataFrame(rows, "date date, header_fingerprint string, path string")


LAYOUT_ROWS = "SELECT date AS file_date, CAST(date AS VARCHAR) AS date, kind, CAST(n AS VARCHAR) AS n, CASE WHEN day(date) % 3 = 2 THEN kind || '!' END AS note FROM ek"


@query(with_sql(LAYOUT_ROWS, KINDS))
def layout_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three layouts, each read by its own scan, united by name; the day is that of the file's name."""
    _, days = daily_files(spark, sf_dir)
    return files.read_days(spark, days).select(F.col(FILE_DATE).alias("file_date"), "date", "kind", "n", "note")


@query(with_sql("SELECT CASE day(date) % 3 WHEN 0 THEN substr(sha256('date,kind,n'), 1, 12) WHEN 1 THEN substr(sha256('n,date,kind'), 1, 12) ELSE substr(sha256('date,kind,n,note'), 1, 12) END AS fingerprint, min(date) AS since, count(*) AS days FROM (SELECT DISTINCT date FROM ek) GROUP BY 1", KINDS))
def layout_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, days = daily_files(spark, sf_dir)
    return files.layouts(days).select(F.col("header_fingerprint").alias("fingerprint"), "since", F.size("paths").cast("bigint").alias("days"))


@query(with_sql(LAYOUT_ROWS.replace("date AS file_date, ", ""), KINDS))
def any_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = daily_files(spark, sf_dir)
    return files.read_any_csv(spark, f"{root}/*.csv").select("date", "kind", "n", "note")


class _Server:
    """Archives in memory, as a server would give them; it breaks off once."""

    def __init__(self, content: dict[str, bytes]):
        self.content, self.broken = content, False

    def head(self, url: str) -> archives.Remote:
        return archives.Remote(url, len(self.content[url]), "1")

    def get(self, url: str, start: int) -> tuple[int, list[bytes]]:
        body = self.content[url][start:]
        if not self.broken:
            self.broken, body = True, body[: len(body) // 2]
        return (206 if start else 200), [body]


def archived(spark: SparkSession, sf_dir: str) -> tuple[archives.RawStore, Path, str]:
    """The days of the first quarter of events as an archive that was fetched, after a download that broke off."""
    counted = kinds(spark, sf_dir)
    quarter = Quarter.containing(min(counted))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for day, rows in counted.items():
            end = ("\n", "\r\n", "\r")[day.day % 3]
            z.writestr(f"data/{day}.csv", end.join(["date,serial_number,model,capacity_bytes,failure", *(f"{day},{k},M,{n},0" for k, n in rows)]) + end)
        z.writestr("__MACOSX/._notes.csv", "")
        z.writestr("notes.txt", "no day")
    root = Path(tempfile.mkdtemp(prefix="archives-"))  # read by the driver only
    server, store, url = _Server({f"http://host/{quarter.archive}": raw.getvalue()}), archives.RawStore(root / "raw"), f"http://host/{quarter.archive}"
    try:
        archives.fetch(server, url, store, root / "work")
    except archives.ArchiveError:
        archives.fetch(server, url, store, root / "work")
    return store, root / "bronze", quarter.archive


@query(with_sql("SELECT date, count(*) AS rows, CASE day(date) % 3 WHEN 0 THEN 'lf' WHEN 1 THEN 'crlf' ELSE 'cr' END AS line_endings, 'ok' AS status, CASE WHEN day(date) % 3 = 2 THEN 1 ELSE 0 END AS notes FROM ek GROUP BY 1, 3, 5", KINDS))
def archive_days_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch with resumption, check, extract, manifest: the days that the manifest lists. A second extraction finds it there."""
    store, bronze, name = archived(spark, sf_dir)
    _, manifest = archives.extract(store, bronze, name, DEFAULT)
    status, again = archives.extract(store, bronze, name, DEFAULT)
    if status != "unchanged" or again != manifest or len(manifest.ignored) != 2:
        raise AssertionError(f"a second extraction was {status}, ignored: {manifest.ignored}")
    rows = [(d.date, d.rows, d.line_endings, d.status, len(d.file_warnings)) for d in manifest.days]
    return spark.createDataFrame(rows, "date date, rows long, line_endings string, status string, notes int")


@query(with_sql("SELECT date, substr(sha256('date,serial_number,model,capacity_bytes,failure'), 1, 12) AS fingerprint, 5 AS columns FROM (SELECT DISTINCT date FROM ek)", KINDS))
def archive_header_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, name = archived(spark, sf_dir)
    rows = archives.header_census(store.root / store.record(name).raw_key, DEFAULT)
    return spark.createDataFrame([(r["date"], r["fingerprint"], len(r["columns"])) for r in rows], "date date, fingerprint string, columns int")


@query(with_sql(f"SELECT DISTINCT {YEAR_QUARTER} AS year_quarter, CAST(date_trunc('quarter', date) AS DATE) AS first, CAST(last_day(date_trunc('quarter', date) + INTERVAL 2 MONTH) AS DATE) AS last, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH AS DATE) AS next_first, CAST(date_diff('day', date_trunc('quarter', date), date_trunc('quarter', date) + INTERVAL 3 MONTH) AS INTEGER) AS days FROM pp", PART_PANEL))
def quarter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = {Quarter.containing(r["date"]) for r in part_panel(spark, sf_dir).select("date").distinct().collect()}  # a row per day
    rows = [(f"{q.first.year}-Q{str(q)[1]}", q.first, q.last, (Quarter.spelled(str(q)) + 1).first, len(archive_days(q.archive, date.min))) for q in quarters]
    return spark.createDataFrame(rows, "year_quarter string, first date, last date, next_first date, days int")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small table written as JSON lines, twice, and read back."""
    at, nations = f"{shared_folder(spark, 'jsonl')}/nation", read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for _ in range(2):
        files.write_jsonl(nations, at)
    return files.read_jsonl(spark, at, nations.schema)


@query("SELECT r_regionkey, r_name FROM region")
def seed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, regions = f"{shared_folder(spark, 'seed')}/region", read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    regions.write.option("header", True).csv(at)
    return files.read_seed(spark, at, ", ".join(f"{n} {t}" for n, t in regions.dtypes))


@query(with_sql("SELECT file_date, model IS NULL AS no_model, dc, count(*) AS n FROM (SELECT file_date, model, CASE WHEN year(file_date) >= 1998 THEN dc END AS dc FROM rs WHERE reasons = '') GROUP BY 1, 2, 3", TEXT, REASONS_SQL))
def cast_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts cast one by one, then stacked: the older lacks a column."""
    rows = text_rows(spark, sf_dir)
    newer = F.year(FILE_DATE) >= 1998
    good, _ = cast_all([rows.filter(newer), rows.filter(~newer).drop("datacenter")], DEFAULT)
    return good.groupBy(F.col("date").alias("file_date"), F.col("model").isNull().alias("no_model"), F.col("datacenter").alias("dc")).agg(F.count("*").alias("n"))


# Headers of a drill, with the days they come on.
DRILL = (("date,serial_number,model,capacity_bytes,failure", "2014-01-01"), ("date,serial_number,model,capacity_bytes,failure,smart_1_raw,rack", "2014-01-01"), ("date,serial_number,model,failure,smart_9_normalized", "2023-05-01"))


@query("SELECT * FROM (VALUES ('2014-01-01', 5, '', 0), ('2014-01-01', 7, 'new column not matching the counter pattern: rack', 0), ('2023-05-01', 5, 'required column missing: capacity_bytes', 3)) AS t(day, columns, blocks, warnings)")
def header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for header, day in DRILL:
        blocks, warnings = DEFAULT.drift(header.split(","), date.fromisoformat(day))
        rows.append((day, len(header.split(",")), "; ".join(blocks), len(warnings)))
    return spark.createDataFrame(rows, "day string, columns int, blocks string, warnings int")


@query(with_sql("SELECT date, 'warn' AS status, CAST(row_number() OVER (ORDER BY date) + 1000 AS BIGINT) AS bronze_rows, CAST(0 AS BIGINT) AS silver_rows, 'known source defect, not loaded: copy of 2022-12-11 (the real 2022-12-10 readings are not in the release)' AS note FROM (SELECT DATE '2022-12-10' AS date)"))
def known_defect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """December 2022 by the contract: the day that is a copy of the next one becomes a known gap, no other does."""
    days = spark.createDataFrame([(date(2022, 12, 1) + timedelta(days=n), 992 + n) for n in range(31)], "date date, row_count long")
    return audit.defect_verdicts(days, DEFAULT.defects).select("date", "status", "bronze_rows", "silver_rows", F.col("warnings")[0].alias("note"))


PUBLISHED = """SELECT date, CASE WHEN date_diff('day', DATE '1995-01-01', date) % 97 = 0 THEN 'first' ELSE 'second' END AS load, count(*) FILTER (date_diff('day', DATE '1995-01-01', date) % 97 = 0 OR serial_number % 2 = 0) AS rows
FROM pp GROUP BY 1, 2 HAVING rows > 0"""


@query(with_sql(PUBLISHED, PART_PANEL))
def publish_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days published, then again with half their rows: blocked days keep those of the first load. A load whose counts are wrong changes nothing."""
    lake = Lake(spark, shared_folder(spark, "publish"))
    panel = part_panel(spark, sf_dir).select("date", "serial_number", "model").withColumn("load", F.lit("first")).persist()
    blocked = F.datediff("date", F.lit("1995-01-01").cast("date")) % 97 == 0
    bad = spark.createDataFrame([], "_file_date date, _source_file string, reasons array<string>, raw string")

    def verdicts(rows: DataFrame, status: Column, more: int = 0) -> DataFrame:
        counted = panel.select("date").distinct().join(rows.groupBy("date").agg(F.count("*").alias("n")), "date", "left")
        return counted.select("date", status.alias("status"), (F.coalesce("n", F.lit(0)) + more).cast("bigint").alias("silver_rows"), F.lit(0).cast("bigint").alias("quarantined_rows"))

    half = panel.filter(F.col("serial_number") % 2 == 0).withColumn("load", F.lit("second"))
    publish(lake, "silver", "quarantine", "days", panel, bad, verdicts(panel, F.lit("ok")), "r1")
    publish(lake, "silver", "quarantine", "days", half, bad, verdicts(half, F.when(blocked, "blocked").otherwise("ok")), "r2")
    try:
        publish(lake, "silver", "quarantine", "days", panel, bad, verdicts(panel, F.lit("ok"), more=1), "r3")
        raise AssertionError("a load with wrong counts was published")
    except PublishError:
        pass
    panel.unpersist()
    return lake.read("silver").groupBy("date", "load").agg(F.count("*").alias("rows"))


@query(with_sql("SELECT year(date) AS y, count(*) AS rows, count(slot_num) AS slots FROM (SELECT date, CASE WHEN date >= DATE '1998-01-01' THEN slot_num END AS slot_num FROM pp) GROUP BY 1", PART_PANEL))
def append_evolves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended days bring a column that older ones lack."""
    lake, panel = Lake(spark, shared_folder(spark, "append")), part_panel(spark, sf_dir)
    newer = F.col("date") >= "1998-01-01"
    lake.append("silver", panel.filter(~newer).select("date", "serial_number"), sort="serial_number")
    lake.append("silver", panel.filter(newer).select("date", "serial_number", "slot_num"), sort="serial_number")
    return lake.read("silver").groupBy(F.year("date").cast("bigint").alias("y")).agg(F.count("*").alias("rows"), F.count("slot_num").alias("slots"))


@query(with_sql("SELECT what, n FROM (SELECT 'rows' AS what, count(*) AS n FROM pp WHERE date < DATE '1996-01-01' OR date >= DATE '1997-01-01' UNION ALL SELECT 'snapshots', 1 UNION ALL SELECT 'orphans before', 1 UNION ALL SELECT 'orphans after expiry', 1 UNION ALL SELECT 'files a year, at most', 1)", PART_PANEL))
def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days deleted, files compacted, snapshots expired, orphans reported and not deleted."""
    lake, panel = Lake(spark, shared_folder(spark, "maintenance")), part_panel(spark, sf_dir).select("date", "serial_number", "model")
    lake.append("silver", panel, sort="serial_number")
    gone = [r["date"] for r in panel.filter(F.year("date") == 1996).select("date").distinct().collect()]  # days of a year
    lake.delete_days("silver", gone, sort="serial_number")
    lake.rewrite("silver", sort="serial_number", everything=True)
    write_text(spark, f"{lake.root}/silver/data/lost.parquet", "no manifest lists this")
    before = lake.orphans("silver").count()
    lake.expire("silver", keep_for=timedelta(0))
    most = max(r["count"] for r in lake.files("silver").groupBy("partition").count().collect())
    rows = [("rows", lake.read("silver").count()), ("snapshots", len(lake._manifests("silver"))), ("orphans before", before), ("orphans after expiry", lake.orphans("silver").count()), ("files a year, at most", most)]
    return spark.createDataFrame(rows, "what string, n long")


@query(with_sql("SELECT * FROM fq", PART_PANEL, QUARTERS, FLEET_QUARTER))
def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models built in the order of their needs, each written once and read by the next."""
    graph = ModelGraph()
    graph.add("afr_fleet_quarter", lambda quarters: models.afr_fleet_quarter(quarters, ERAS), "device_quarter")
    graph.add("device_quarter", models.device_quarter, "panel", partition_by=("year_quarter",))
    return graph.build(spark, shared_folder(spark, "gold"), {"panel": part_panel(spark, sf_dir)})["afr_fleet_quarter"]


@query(with_sql("SELECT date, n AS row_count FROM (SELECT date, sum(n) AS n FROM ek GROUP BY 1) WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND day(date) % 5 <> 0 AND day(date) % 7 <> 0".replace("n AS row_count", "CAST(n AS BIGINT) AS row_count"), KINDS))
def days_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current days in range that aren't blocked."""
    day = F.dayofmonth("date")
    days = read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("date")).agg(F.count("*").alias("row_count"))
    marked = days.select("*", (day % 5 != 0).alias("is_current"), F.when(day % 7 == 0, "blocked").otherwise("ok").alias("status"))
    return loading.select_days(marked, date(2024, 1, 5), date(2024, 1, 20)).select("date", "row_count")


@query("SELECT * FROM (VALUES ('next', 'Q1_2026', true), ('named', 'Q3_2025', false), ('retried', '3', true), ('stopped', 'sense', true), ('scan limit', 'ScanTooLarge', true)) AS t(step, outcome, ok)")
def control_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, tries = [], []
    target = next_target(date(2025, 12, 31), "http://host", lambda url: url == "http://host/data_Q1_2026.zip")
    rows.append(("next", str(target.quarter), target.available))
    named = next_target(None, "http://host", lambda _: False, "Q3_2025")
    rows.append(("named", str(named.quarter), named.available))

    def flaky(state: dict) -> dict:
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return {"done": True}

    run_stages([("flaky", flaky)])
    rows.append(("retried", str(len(tries)), True))
    state = run_stages([("sense", lambda s: {"at": "sense", "stop": True}), ("never", lambda s: {"at": "never"})])
    rows.append(("stopped", state["at"], state["stop"]))
    try:
        scan_guard(read(spark, sf_dir, "lineitem"), 1000)
    except ScanTooLarge as e:
        rows.append(("scan limit", type(e).__name__, True))
    return spark.createDataFrame(rows, "step string, outcome string, ok boolean")


RUNS = "runs AS (SELECT o_orderpriority AS pipeline, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 3 WHEN 0 THEN 'sense' WHEN 1 THEN 'load' ELSE 'build' END AS stage, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'failed' ELSE 'done' END AS state FROM orders)"
TODAY = date(2001, 6, 1)
ALARMS = f"""SELECT pipeline, 'failed' AS alarm, min(day) AS since, count(*) AS n FROM runs WHERE state = 'failed' AND day > DATE '{TODAY}' - 30 GROUP BY 1
UNION ALL SELECT pipeline, 'sensor', min(day), count(*) FROM runs WHERE state = 'failed' AND stage = 'sense' AND day > DATE '{TODAY}' - 30 GROUP BY 1
UNION ALL SELECT pipeline, 'silent', max(day), date_diff('day', max(day), DATE '{TODAY}') FROM runs GROUP BY 1 HAVING date_diff('day', max(day), DATE '{TODAY}') > 1"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as runs: their priority is the pipeline, their status the outcome."""
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("pipeline"), F.col("o_orderdate").cast("date").alias("day"), F.when(key % 3 == 0, "sense").when(key % 3 == 1, "load").otherwise("build").alias("stage"),
        F.when((F.col("o_orderstatus") == "F") & (key % 2 == 0), "failed").otherwise("done").alias("state"),
    )


@query(with_sql(ALARMS, RUNS))
def run_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms.run_alarms(runs(spark, sf_dir), TODAY, recent_days=30)


@query(with_sql("SELECT pipeline, day, CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(failed) AS BIGINT) AS failed, arg_max(stage, (failed, -ascii(stage))) FILTER (failed > 0) AS worst_stage FROM (SELECT pipeline, day, stage, count(*) AS runs, count(*) FILTER (state = 'failed') AS failed FROM runs GROUP BY 1, 2, 3) GROUP BY 1, 2", RUNS))
def run_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms.run_board(runs(spark, sf_dir))
