import urllib.error
import zipfile
from datetime import date

import pytest

from telemark.functions.contract import DEFAULT
from telemark.operators import bookkeeping
from telemark.sources import archives, files


def test_layouts_oldest_first_with_differences(spark):
    headers = spark.createDataFrame([("f1", ["date", "a"]), ("f2", ["date", "a", "b"]), ("f3", ["b", "date"])], "fingerprint string, columns array<string>")
    days = spark.createDataFrame([(date(2020, 1, 1), "f1"), (date(2020, 1, 2), "f1"), (date(2020, 2, 1), "f2"), (date(2020, 3, 1), "f3")], "date date, fingerprint string")
    rows = bookkeeping.layouts_used(days, headers).orderBy("first_day").collect()
    assert [(r.fingerprint, r.days, r.column_count, r.added, r.removed) for r in rows] == [("f1", 2, 2, [], []), ("f2", 1, 3, ["b"], []), ("f3", 1, 2, [], ["a"])]


def test_missing_and_unexpected(spark):
    dates = lambda *days: spark.createDataFrame([(date(2020, 1, d),) for d in days], "date date")
    got = {(r.date.day, r.what) for r in bookkeeping.missing_and_unexpected(dates(1, 2, 9), dates(1, 2, 3)).collect()}
    assert got == {(3, "missing"), (9, "unexpected")}


def test_versions(spark):
    rows = [("a", "1", "2020-01-01 00:00:00", False, True), ("a", "2", "2020-01-02 00:00:00", True, True), ("a", "3", "2020-01-03 00:00:00", False, True)]
    versions = spark.createDataFrame(rows, "source string, sha string, stored_at string, is_current boolean, extracted boolean").selectExpr("source", "sha", "cast(stored_at as timestamp) stored_at", "is_current", "extracted")
    got = {r.sha: r.superseded_by for r in bookkeeping.superseded(versions).collect()}
    assert got == {"1": "2", "2": None, "3": "2"}  # the last was reverted: the current one replaced it
    days = spark.createDataFrame([("a", "3", date(2020, 1, 1), "x"), ("a", "1", date(2020, 1, 1), "y"), ("a", "2", date(2020, 1, 1), "x")], "source string, sha string, date date, day_sha string")
    assert [r.change for r in bookkeeping.day_changes(days, versions).collect()] == ["same"]  # against the latest stored before


def test_one_path_per_day(tmp_path):
    at = tmp_path / "date=2024-05-01" / "src=abcdef12"
    with pytest.raises(FileNotFoundError):
        files.day_path(date(2024, 5, 1), "abcdef1234", str(tmp_path))
    at.mkdir(parents=True)
    (at / "2024-05-01.csv.gz").write_bytes(b"")
    assert files.day_path(date(2024, 5, 1), "abcdef1234", str(tmp_path)) == str(at / "2024-05-01.csv.gz")


def test_seed(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('priority,pattern,manufacturer\n1,"A%",Alder\n99,%,Unknown\n')
    seed = files.read_seed(spark, str(tmp_path / "seed.csv"), "priority int, pattern string, manufacturer string")
    assert [tuple(r) for r in seed.orderBy("priority").collect()] == [(1, "A%", "Alder"), (99, "%", "Unknown")]


def test_header_census(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("2024-05-02.csv", "b,a\r1,2\r")
        z.writestr("2024-05-01.csv", "a,b\n1,2\n")
        z.writestr("2024-05-03.csv", ",".join(f"column_{i}" for i in range(20_000)) + "\n1\n")
    rows = archives.header_census(tmp_path / "a.zip", DEFAULT)
    assert [r["columns"] for r in rows[:2]] == [["a", "b"], ["b", "a"]]
    assert len(rows[2]["columns"]) == 20_000  # longer than one read
    assert rows[0]["fingerprint"] != rows[1]["fingerprint"] and rows[0]["any_order"] == rows[1]["any_order"]


def test_probe():
    class Response:
        status = 200

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

    def failing(code):
        def opener(request, timeout):
            raise urllib.error.HTTPError(request.full_url, code, "", {}, None)

        return opener

    assert archives.is_published("http://host/a", lambda *_, **__: Response())
    assert not archives.is_published("http://host/a", failing(404))
    with pytest.raises(urllib.error.HTTPError):
        archives.is_published("http://host/a", failing(500))
