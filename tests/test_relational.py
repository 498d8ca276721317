"""Relational operators on small constructed tables: values, and what they keep in memory."""

from datetime import date

from pyspark.sql import functions as F

from telemark.operators import relational
from test_plans import plan


def test_unstable_counts_values_and_not_nulls(spark):
    rows = spark.createDataFrame([(1, "a", 1, 0.0), (1, None, 2, -0.0), (2, "a", None, 1.0), (2, "b", None, 2.0), (3, None, 3, None), (None, "a", 1, 1.0), (None, "b", 1, float("nan"))], "k int, name string, n int, x double")
    found = relational.unstable(rows, "k", ["name", "n", "x"])
    assert tuple(found.first()) == (2, 1, 2)
    assert "Expand" not in plan(found)


def test_look_back_gives_a_row_a_day_without_a_table_of_rows(spark):
    d = lambda n: date(2020, 1, n)
    rows = spark.createDataFrame([(1, d(1), 5), (1, d(9), 6), (1, d(9), 6), (1, d(20), 7), (2, d(9), 8), (3, None, 9), (3, None, 9)], "k int, day date, v int")
    found = relational.latest_between(rows, "k", "day", "v", 14, 7)
    assert sorted((tuple(r) for r in found.filter(F.col("day").isNotNull()).collect())) == [(1, d(1), None), (1, d(9), 5), (1, d(20), 6), (2, d(9), None)]
    assert found.filter("k = 3").count() == 1
    assert "Aggregate" not in plan(found)
