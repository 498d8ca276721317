"""The daily models as streams: late data within a watermark, and idempotent day replacement per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.snapshots import Lake

DAY = "1 day"


def read_events(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int = 50) -> DataFrame:
    """A directory of Parquet files as an unbounded table; new files are found by the source."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def daily_counts(events: DataFrame, time: str = "ts", lateness: str = "3 days") -> DataFrame:
    """Per day: rows and errors; a day closes once the watermark has passed it."""
    day = F.window(time, DAY)
    counted = events.withWatermark(time, lateness).groupBy(day.alias("w")).agg(F.count("*").alias("rows"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return counted.select(F.col("w.start").cast("date").alias("date"), "rows", "errors")


def sliding_counts(events: DataFrame, time: str = "ts", width: str = "30 days", lateness: str = "3 days") -> DataFrame:
    """Per day end: rows of the last ``width``."""
    w = F.window(time, width, DAY)
    return events.withWatermark(time, lateness).groupBy(w.alias("w")).agg(F.count("*").alias("rows")).select(F.date_sub(F.col("w.end").cast("date"), 1).alias("date"), "rows")


def sessions(events: DataFrame, time: str = "ts", key: str = "user_id", gap: str = "2 hours", lateness: str = "1 day") -> DataFrame:
    w = F.session_window(time, gap)
    return events.withWatermark(time, lateness).groupBy(key, w.alias("w")).agg(F.count("*").alias("rows")).select(key, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "rows")


def replace_days_sink(rows: DataFrame, lake: Lake, table: str, checkpoint: str, day: str = "date") -> StreamingQuery:
    """Each micro-batch replaces its days in a snapshot table; a batch that runs again leaves the same rows."""

    def write(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            days = [r[0] for r in batch.select(day).distinct().collect()]  # days of one batch
            if days:
                lake.replace_days(table, batch, days, day)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(rows: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Drain the source into an in-memory table: for tests and small results."""
    spark = rows.sparkSession
    query = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)
