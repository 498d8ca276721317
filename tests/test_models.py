import math
from datetime import date, timedelta

from telemark.plans import models
from telemark.plans.assertions import accepted_values, not_null, run_assertions, unique
from telemark.plans.models import COUNTERS, Era

D = date(2020, 1, 1)
SILVER = "serial_number string, date date, model string, capacity_bytes bigint, failure boolean, slot_num int, hours bigint, " + ", ".join(f"{c} bigint" for c in COUNTERS)


def silver(spark, *rows):
    """(serial, day number, model, failure, counter) rows of large devices."""
    return spark.createDataFrame([(s, D + timedelta(days=n), m, 4 * 10**12, f, None, 24 * n, *[c] * len(COUNTERS)) for s, n, m, f, c in rows], SILVER)


def dim(spark):
    return spark.createDataFrame([("M", "Alder", 4 * 10**12, 4.0)], "model string, manufacturer string, capacity_bytes bigint, capacity_tb double")


def test_look_back_respects_gaps(spark):
    rows = silver(spark, ("a", 0, "M", False, 1), ("a", 10, "M", False, 5), ("a", 12, "M", False, None), ("a", 40, "M", False, 9))
    got = {r.date: r for r in models.feature_day(rows, dim(spark), str(D)).collect()}
    assert got[D + timedelta(days=10)].realloc_7d == 4  # ten days back
    assert got[D + timedelta(days=12)].realloc_7d is None  # null today
    last = got[D + timedelta(days=40)]
    assert (last.realloc_7d, last.realloc_30d, last.realloc_max_30d) == (None, 4, 9)  # nothing 7-14 days back; day 10 is 30 back


def test_labels_have_three_values(spark):
    rows = silver(spark, *[("a", n, "M", n == 50, 0) for n in range(0, 60, 5)], ("b", 0, "M", False, 0), ("b", 90, "M", False, 0))
    got = {(r.serial_number, (r.date - D).days): r.label_fail_30d for r in models.feature_day(rows, dim(spark), str(D)).collect()}
    assert got["a", 15] == 0 and got["a", 20] == 1 and got["a", 45] == 1
    assert ("a", 50) not in got and ("a", 55) not in got
    assert got["b", 0] == 0 and got["b", 90] is None


def test_null_reading_is_the_last_reading(spark):
    rows = silver(spark, ("a", 0, "M", False, 3), ("a", 30, "M", False, 4), ("a", 31, "M", False, None), ("a", 40, "M", True, 7))
    row = models.device_failure(rows, dim(spark)).first()
    assert (row.realloc, row.realloc_7d, row.rows_in_window, row.any_warning, row.age_days) == (7, None, 3, True, 40)


def test_survival_and_curve_by_hand(spark):
    lives = [("g", 10, 1), ("g", 10, 0), ("g", 20, 1), ("g", 30, 1)]
    curve = models.kaplan_meier(spark.createDataFrame(lives, "g string, duration_days int, event int"), "g", 1, 1).orderBy("duration_days").collect()
    assert [(r.at_risk, r.failures) for r in curve] == [(4, 1), (2, 1), (1, 1)]
    assert [r.survival for r in curve] == [0.75, 0.375, 0.0]  # the last at risk fails: zero, not a null logarithm


def test_curve_stops_where_few_are_at_risk(spark):
    lives = [("g", n, 0) for n in range(100, 110)]
    curve = models.kaplan_meier(spark.createDataFrame(lives, "g string, duration_days int, event int"), "g", 5, 4)
    assert curve.count() == 7
    assert models.alive_after(curve, "g", (1,)).first().alive_1y is None


def test_left_truncated_devices_are_out(spark):
    rows = silver(spark, ("a", 0, "M", False, 0), ("b", 1, "M", False, 0), ("b", 5, "M", True, 0), ("b", 9, "M", False, 0), ("c", 3, "M", False, 0), ("d", 4, "M", False, 0), ("d", 9, "M", False, 0))
    got = {r.serial_number: (r.duration_days, r.event, r.end_reason) for r in models.survival(rows, dim(spark)).collect()}
    assert got == {"b": (5, 1, "failed"), "c": (1, 0, "removed"), "d": (6, 0, "still_running")}


def test_eras_choose_their_rule(spark):
    rows = [("2018-Q4", "a", "M", 90, 1, True, False), ("2020-Q1", "a", "M", 90, 1, True, False), ("2024-Q1", "a", "M", 90, 1, True, False), ("2024-Q1", "b", "M", 90, 0, True, True)]
    quarters = spark.createDataFrame(rows, "year_quarter string, serial_number string, model string, drive_days bigint, failures bigint, at_quarter_end boolean, is_boot boolean")
    got = {r.year_quarter: r for r in models.afr_fleet_quarter(quarters, (Era("2019", 1), Era("2023", 2), Era(None, 0, 100))).collect()}
    assert (got["2018-Q4"].afr_drive_days, got["2020-Q1"].afr_drive_days, got["2024-Q1"].afr_drive_days) == (90, 0, 0)
    assert got["2020-Q1"].afr_pct is None
    assert got["2024-Q1"].boot_drives == 1
    assert math.isclose(got["2018-Q4"].afr_pct, round(1 / (90 / 365) * 100, 2))


def test_assertions_return_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int")
    broken = run_assertions({"null": lambda: not_null(df, "k"), "unique": lambda: unique(df.dropna(), "k"), "values": lambda: accepted_values(df, "k", ("a",))})
    assert sorted(broken) == ["null", "unique"]
