from datetime import date, datetime

from pyspark.sql import functions as F

from telemark.sources.snapshots import Lake
from telemark.streaming import daily


def test_batches_replace_their_days(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    schema = "date date, n int"
    for name, n in (("a", 1), ("b", 2)):
        spark.createDataFrame([(date(2024, 1, 1), n)], schema).write.parquet(str(tmp_path / "in" / name))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        daily.replace_days_sink(stream, lake, "days", str(tmp_path / "check")).awaitTermination()
        assert [r.n for r in lake.read("days").collect()] == [n]


def test_windows_and_sessions(spark, tmp_path):
    rows = [(7, datetime(2024, 1, 1, 0), "error"), (7, datetime(2024, 1, 1, 1), "view"), (7, datetime(2024, 1, 1, 9), "view"), (8, datetime(2024, 1, 2, 0), "view")]
    spark.createDataFrame(rows, "user_id int, ts timestamp, event_type string").write.parquet(str(tmp_path / "e"))
    stream = daily.read_events(spark, str(tmp_path / "e"), "user_id int, ts timestamp, event_type string")
    counts = {str(r.date): (r.rows, r.errors) for r in daily.run_to_table(daily.daily_counts(stream), "t_daily").collect()}
    assert counts == {"2024-01-01": (3, 1), "2024-01-02": (1, 0)}
    found = daily.run_to_table(daily.sessions(stream), "t_sessions", "complete").filter(F.col("user_id") == 7).orderBy("started").collect()
    assert [r.rows for r in found] == [2, 1]
