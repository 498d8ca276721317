"""The driver's tables seen as daily panels.

part panel: one row per order line; device = part, day = ship date, model = brand and type.
supplier panel: one row per supplier and day, with counters; model = nation.
event days: rows per day of the event log.
Each is given twice: as a DataFrame, and as the SQL of the same rows for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_returnflag", "l_quantity", "l_linenumber")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("l_partkey").alias("serial_number"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat_ws(" ", "p_brand", "p_type").alias("model"),
        (F.col("p_size").cast("bigint") * 100_000_000_000).alias("capacity_bytes"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)).alias("failure"),
        F.when((F.col("p_size") >= 10) & (F.col("l_linenumber") <= 5), F.col("l_linenumber")).alias("slot_num"),
    )


PART_PANEL = """pp AS (
  SELECT l_partkey AS serial_number, CAST(l_shipdate AS DATE) AS date, p_brand || ' ' || p_type AS model,
         CAST(p_size AS BIGINT) * 100000000000 AS capacity_bytes, (l_returnflag = 'R' AND l_quantity >= 49) AS failure,
         CASE WHEN p_size >= 10 AND l_linenumber <= 5 THEN l_linenumber END AS slot_num
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date")).agg(
        F.max("l_quantity").cast("bigint").alias("most"),
        F.count("*").alias("n"),
        F.sum("l_linenumber").cast("bigint").alias("numbers"),
        F.max("l_linenumber").cast("bigint").alias("top"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    suppliers = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("serial_number"),
        "date",
        F.col("n_name").alias("model"),
        ((1 + F.col("l_suppkey") % 12) * 250_000_000_000).alias("capacity_bytes"),
        ((F.col("most") >= 50) & (F.col("returned") >= 2)).alias("failure"),
        (F.datediff("date", F.lit("1995-01-01").cast("date")) * 24 + F.col("l_suppkey")).cast("bigint").alias("hours"),
        F.nullif("most", F.lit(13)).alias("realloc"),
        (F.col("n") - 1).alias("uncorrect"),
        F.col("numbers").alias("timeout"),
        (F.col("top") - 1).alias("pending"),
        F.col("returned").alias("offline"),
    )


SUPPLIER_PANEL = """sp AS (
  SELECT l_suppkey AS serial_number, d AS date, n_name AS model, (1 + l_suppkey % 12) * 250000000000 AS capacity_bytes,
         (most >= 50 AND returned >= 2) AS failure, CAST(date_diff('day', DATE '1995-01-01', d) * 24 + l_suppkey AS BIGINT) AS hours,
         nullif(most, 13) AS realloc, n - 1 AS uncorrect, numbers AS timeout, top - 1 AS pending, returned AS offline
  FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(max(l_quantity) AS BIGINT) AS most, count(*) AS n,
               CAST(sum(l_linenumber) AS BIGINT) AS numbers, CAST(max(l_linenumber) AS BIGINT) AS top, count(*) FILTER (l_returnflag = 'R') AS returned
        FROM lineitem GROUP BY 1, 2)
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)"""


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("date")).agg(F.count("*").alias("row_count"))


EVENT_DAYS = "ed AS (SELECT CAST(ts AS DATE) AS date, count(*) AS row_count FROM events GROUP BY 1)"

# Patterns by priority, for the part panel and for the supplier panel.
PART_PATTERNS = ((1, "Brand#1%", "Alder"), (2, "Brand#2%", "Birch"), (3, "% PROMO", "Cedar"), (99, "%", "Unknown"))
SUPPLIER_PATTERNS = ((1, "NATION_1%", "Alder"), (2, "%2%", "Birch"), (3, "%N%", "Cedar"), (99, "%", "Unknown"))
PATTERN_SCHEMA = "priority int, pattern string, manufacturer string"


def patterns(spark: SparkSession, rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), PATTERN_SCHEMA)


def values_sql(rows: tuple, name: str, columns: str) -> str:
    spelled = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {spelled})"
