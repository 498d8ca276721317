import io
import zipfile
from datetime import date, timedelta

import pytest

from telemark.functions.contract import DEFAULT
from telemark.functions.quarters import Quarter
from telemark.plans.alarms import run_alarms, run_board
from telemark.plans.daily_run import DailyRun
from telemark.sources.archives import RawStore, Remote
from telemark.sources.snapshots import Lake

HEADER = "date,serial_number,model,capacity_bytes,failure,smart_9_raw,smart_5_raw"


def archive(quarter, days, devices):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for n in range(days):
            day = quarter.first + timedelta(days=n)
            rows = [f"{day},S{i},{'A' if i % 2 else 'B'}1,4000000000000,{int(n == days - 1 and i == 3)},{24 * n},{n}" for i in range(devices)]
            z.writestr(f"{day}.csv", "\n".join([HEADER, *rows]) + "\n")
    return raw.getvalue()


class Server:
    def __init__(self, content):
        self.content = content

    def head(self, url):
        return Remote(url, len(self.content[url]), "1")

    def get(self, url, start):
        return 200, [self.content[url]]


@pytest.fixture
def daily(spark, tmp_path):
    quarters = [Quarter.of(2023, 4), Quarter.of(2024, 1)]
    server = Server({f"http://host/{q.archive}": archive(q, 3, 12) for q in quarters})
    patterns = spark.createDataFrame([(1, "A%", "Alder"), (99, "%", "Unknown")], "priority int, pattern string, manufacturer string")
    lake = Lake(spark, f"file://{tmp_path}/lake")
    return DailyRun(spark, lake, RawStore(tmp_path / "raw"), tmp_path / "bronze", tmp_path / "work", DEFAULT, server, "http://host", lambda url: url in server.content, patterns, str(tmp_path / "tables"), "2023-10-02")


def test_from_archive_to_models(spark, daily):
    state = daily.run("Q4_2023")
    assert (state["fetched"], state["extracted"], state["days"]) == ("stored", "extracted", 3)
    assert state["loaded"].released == [date(2023, 10, 1) + timedelta(days=n) for n in range(3)]
    gold = lambda name: spark.read.parquet(f"{daily.tables}/gold/{name}")
    assert state["built"] and gold("fleet_daily").count() == 3
    assert {r.manufacturer for r in gold("dim_model").collect()} == {"Alder", "Unknown"}
    assert [(r.serial_number, r.age_days, r.realloc) for r in gold("device_failure").collect()] == [("S3", 2, 2)]
    assert gold("feature_day").filter("date >= '2023-10-02'").count() == gold("feature_day").count() == 23
    # The next day senses the quarter after the last one that is loaded; then there is none.
    state = daily.run()
    assert str(state["target"].quarter) == "Q1_2024" and gold("fleet_daily").count() == 6
    state = daily.run()
    assert state["stop"] and "fetched" not in state
    again = daily.run("Q1_2024")
    assert (again["fetched"], again["extracted"]) == ("unchanged", "unchanged")
    assert daily.lake.read("silver").count() == 72
    assert spark.read.json(f"{daily.tables}/header_layouts").count() == 1


def test_history_goes_on_after_a_failure(daily):
    del daily.transport.content["http://host/data_Q1_2024.zip"]
    daily.exists = lambda url: True
    got = daily.history("Q4_2023", "Q1_2024")
    assert list(got["done"]) == ["Q4_2023"] and list(got["failed"]) == ["Q1_2024"]
    assert daily.lake.read("silver").count() == 36


def test_alarms(spark):
    today = date(2024, 5, 10)
    rows = [("a", today, "load", "failed"), ("a", today, "sense", "failed"), ("a", today - timedelta(days=5), "sense", "failed"), ("b", today - timedelta(days=3), "build", "done"), ("c", today, "load", "done")]
    runs = spark.createDataFrame(rows, "pipeline string, day date, stage string, state string")
    got = {(r.pipeline, r.alarm): (r.since, r.n) for r in run_alarms(runs, today).collect()}
    assert got == {("a", "failed"): (today, 2), ("a", "sensor"): (today, 1), ("b", "silent"): (today - timedelta(days=3), 3)}
    board = {(r.pipeline, r.day): (r.runs, r.failed, r.worst_stage) for r in run_board(runs).collect()}
    assert board["a", today] == (2, 2, "load") and board["c", today] == (1, 0, None)
