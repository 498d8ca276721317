"""Data assertions: each returns the rows that break it, so an empty result passes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), F.lit("null").alias("problem"))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    repeated = df.groupBy(*columns).count().filter("count > 1")
    return repeated.select(F.lit(",".join(columns)).alias("column"), F.concat_ws(",", *columns).alias("value"), F.lit("repeated").alias("problem"))


def accepted_values(df: DataFrame, column: str, values: tuple) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column).distinct()
    return bad.select(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), F.lit("not accepted").alias("problem"))


def within_tolerance(reconciled: DataFrame) -> DataFrame:
    """Checked figures that we miss by more than the tolerance, or can't compute."""
    return reconciled.filter((F.col("status") == "check") & (F.col("our_afr_pct").isNull() | (F.abs("difference") > F.col("tolerance"))))


def run_assertions(checks: dict[str, Callable[[], DataFrame]], shown: int = 5) -> dict[str, list]:
    """The first rows of each assertion that fails."""
    found = {name: make().take(shown) for name, make in checks.items()}
    return {name: rows for name, rows in found.items() if rows}
