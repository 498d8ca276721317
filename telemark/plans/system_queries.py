"""Queries over streams and the snapshot table: the state after a scripted sequence."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_folder
from ..sources.snapshots import Lake
from ..streaming import daily
from . import models
from .panels import part_panel, read
from .registry import query

DAYS_SQL = "SELECT CAST(ts AS DATE) AS date, count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1"


@query(DAYS_SQL)
def streaming_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stream of files, counted per day."""
    schema = read(spark, sf_dir, "events").schema
    stream = daily.read_events(spark, sf_dir, schema, "events.parquet")
    return daily.run_to_table(daily.daily_counts(stream.withColumn("ts", F.col("ts").cast("timestamp"))), f"daily_{uuid.uuid4().hex}")


SLIDING_SQL = """SELECT CAST(d.date AS DATE) AS date, count(*) AS rows FROM (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 29 FROM events), INTERVAL 1 DAY)) AS date) d
JOIN events e ON CAST(e.ts AS DATE) BETWEEN CAST(d.date AS DATE) - 29 AND CAST(d.date AS DATE) GROUP BY 1"""


@query(SLIDING_SQL)
def streaming_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    stream = daily.read_events(spark, sf_dir, schema, "events.parquet")
    return daily.run_to_table(daily.sliding_counts(stream.withColumn("ts", F.col("ts").cast("timestamp"))), f"sliding_{uuid.uuid4().hex}")


@query(
    """SELECT date, count(*) AS drives, count(*) FILTER (failure) AS failures FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, (l_returnflag = 'R' AND l_quantity >= 49) AS failure, l_partkey AS serial_number FROM lineitem JOIN part ON l_partkey = p_partkey)
  WHERE date <> DATE '1998-06-15' AND NOT (date = DATE '1998-03-03' AND serial_number % 2 = 1) GROUP BY 1"""
)
def snapshot_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all days, reload one day with half its rows on a branch and release it, empty another, compact by month; then read all back."""
    panel = part_panel(spark, sf_dir)
    lake = Lake(spark, shared_folder(spark, "lake"))
    days = [r["date"] for r in panel.select("date").distinct().collect()]  # days of one load
    lake.replace_days("silver", panel, days, sort="serial_number")
    changed = panel.filter((F.col("date") == "1998-03-03") & (F.col("serial_number") % 2 == 0))
    lake.replace_days("silver", changed, [date(1998, 3, 3)], sort="serial_number", branch="wap_1")
    lake.release(["silver"], "wap_1")
    lake.replace_days("silver", changed, [date(1998, 6, 15)], sort="serial_number")
    lake.rewrite("silver", sort="serial_number", spec="months", since=date(1998, 7, 1), everything=True)
    return models.fleet_daily(lake.read("silver"))
