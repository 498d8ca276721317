"""What is wrong with the runs, and what they did by day: for a page that people look at, and for mail."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_alarms(runs: DataFrame, today: date, quiet_days: int = 1, recent_days: int = 1) -> DataFrame:
    """(pipeline, day, stage, state) to (pipeline, alarm, since, n).

    'failed': runs that failed in the last ``recent_days``; 'sensor': those of them that failed while sensing; 'silent': no
    run at all for more than ``quiet_days``.
    """
    recent = (F.col("state") == "failed") & (F.col("day") > F.date_sub(F.lit(today), recent_days))
    sensing = recent & (F.col("stage") == "sense")
    first = lambda condition: F.min(F.when(condition, F.col("day")))
    each = runs.groupBy("pipeline").agg(
        F.count_if(recent).alias("failed"), first(recent).alias("failed_since"), F.count_if(sensing).alias("sensor"), first(sensing).alias("sensor_since"), F.max("day").alias("last"),
    )
    quiet = F.datediff(F.lit(today), F.col("last"))
    found = F.array_compact(F.array(*(
        F.when(holds, F.struct(F.lit(name).alias("alarm"), since.alias("since"), n.cast("bigint").alias("n")))
        for name, holds, since, n in (
            ("failed", F.col("failed") > 0, F.col("failed_since"), F.col("failed")), ("sensor", F.col("sensor") > 0, F.col("sensor_since"), F.col("sensor")), ("silent", quiet > quiet_days, F.col("last"), quiet),
        )
    )))
    return each.select("pipeline", F.explode(found).alias("x")).select("pipeline", "x.*")


def run_board(runs: DataFrame) -> DataFrame:
    """Per pipeline and day: runs, failures, and the stage that failed most (of equals the first by name)."""
    failed = F.col("state") == "failed"
    stages = runs.groupBy("pipeline", "day", "stage").agg(F.count("*").alias("runs"), F.count_if(failed).alias("failed"))
    worst = F.max_by("stage", F.when(F.col("failed") > 0, F.struct("failed", F.negate(F.ascii("stage")))))
    return stages.groupBy("pipeline", "day").agg(F.sum("runs").alias("runs"), F.sum("failed").alias("failed"), worst.alias("worst_stage"))
