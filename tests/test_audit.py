import statistics
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telemark.functions.contract import Baseline, Limits
from telemark.operators.audit import day_counts, defect_verdicts, judge_days, source_checks

START = date(2024, 1, 1)


def frame(spark, counts):
    rows = [(START + timedelta(days=i), n, "ok") for i, n in enumerate(counts) if n is not None]
    return spark.createDataFrame(rows, "date date, row_count bigint, status string")


def loop(counts, rules):
    """The rule as a plain loop."""
    normal, out = [], []
    for n in counts:
        if n is None:
            out.append((None, None, False, "missing"))
        elif n == 0:
            out.append((0, None, False, "empty"))
        else:
            base = statistics.median(normal[-rules.window :]) if normal else None
            partial = base is not None and n < rules.partial_below * base
            note = "partial" if partial else "unusual" if base is not None and abs(n / base - 1) > rules.warn_beyond else None
            out.append((n, base, partial, note))
            if not partial:
                normal.append(n)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.just(0), st.integers(40, 130)), min_size=1, max_size=25))
def test_baseline_is_the_recursive_rule(spark, counts):
    counts = [100, *counts, 100]
    got = [(r.bronze_rows, r.baseline, r.partial, r.note) for r in source_checks(frame(spark, counts)).orderBy("date").collect()]
    assert got == loop(counts, Baseline())


def test_long_partial_stretch_stays_flagged(spark):
    got = source_checks(frame(spark, [23805] * 7 + [315] * 10 + [25019])).orderBy("date").collect()
    assert [r.partial for r in got] == [False] * 7 + [True] * 10 + [False]
    assert got[-1].note == "unusual"


COUNTS = "date date, cast_good bigint, cast_quarantined bigint, conflict_rows bigint, conflict_drives bigint, silver_rows bigint"


def verdict(spark, bronze, counts, partial=False, note=None, limits=Limits()):
    checks = spark.createDataFrame([(START, bronze, 1000.0, 0.0, partial, note)], "date date, bronze_rows bigint, baseline double, change double, partial boolean, note string")
    return judge_days(checks, spark.createDataFrame([(START, *counts)], COUNTS), limits).first()


def test_verdicts(spark):
    assert verdict(spark, 1000, (1000, 0, 0, 0, 1000)).status == "ok"
    assert verdict(spark, 1000, (990, 0, 0, 0, 990)).blocks == ["rows lost"]
    assert verdict(spark, 1000, (995, 5, 0, 0, 995)).status == "warn"  # exactly the limit
    assert verdict(spark, 1000, (994, 6, 0, 0, 994)).status == "blocked"
    assert verdict(spark, 100_000, (100_000, 0, 100, 50, 99_900)).status == "warn"
    assert verdict(spark, 100_000, (100_000, 0, 102, 51, 99_898)).status == "blocked"
    assert verdict(spark, 1000, (1000, 0, 0, 0, 998)).exact_copies == 2


def test_block_beats_partial(spark):
    assert verdict(spark, 1000, (990, 0, 0, 0, 990), partial=True, note="partial").status == "blocked"
    assert verdict(spark, 1000, (1000, 0, 0, 0, 1000), partial=True, note="partial").status == "partial"


def test_day_counts_start_at_zero(spark):
    told = spark.createDataFrame([], "date date, serial_number string, _copies bigint, _versions bigint")
    bad = spark.createDataFrame([], "_file_date date, raw string")
    row = day_counts(told, bad, spark.createDataFrame([(START,)], "date date")).first()
    assert tuple(row) == (START, 0, 0, 0, 0, 0)


def test_day_counts_of_versions(spark):
    told = spark.createDataFrame([(START, "a", 3, 1), (START, "b", 1, 2), (START, "b", 2, 2), (START, "c", 1, 1)], "date date, serial_number string, _copies bigint, _versions bigint")
    bad = spark.createDataFrame([(START, "{}"), (START + timedelta(days=1), "{}")], "_file_date date, raw string")
    got = {r.date: tuple(r)[1:] for r in day_counts(told, bad, spark.createDataFrame([(START,)], "date date")).collect()}
    assert got == {START: (7, 1, 2, 1, 2), START + timedelta(days=1): (0, 1, 0, 0, 0)}


def test_columns_go_along(spark):
    days = frame(spark, [5, None, 7]).selectExpr("*", "row_count * 2 as twice")
    got = source_checks(days, carry=("twice",)).orderBy("date").collect()
    assert [(r.bronze_rows, r.twice) for r in got] == [(5, 10), (None, None), (7, 14)]
    assert source_checks(days.limit(0)).count() == 0


def test_defects_keep_the_real_count(spark):
    row = defect_verdicts(frame(spark, [7, 8]), {START: "a copy"}).first()
    assert (row.status, row.bronze_rows, row.silver_rows) == ("warn", 7, 0)
    assert row.warnings == ["known source defect, not loaded: a copy"]
