"""Plans are the ones we want: pruned and filtered scans, no product joins, few shuffles."""

import contextlib
import io
import re

import pytest

from telemark.plans import model_queries, quality_queries, registry, relational_queries  # noqa: F401

ONE_ROW_OR_SEED = {"anti_boot", "seen_after_failure", "feat_drive_day", "surv_drive", "km_by_group", "km_alive_after", "assert_labels", "assert_past_only", "assert_failures_match", "assert_totals_match"}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    text = plan(registry.QUERIES["q2"](spark, sf_dir))
    assert "EqualTo(l_partkey,77)" in text and "EqualTo(p_partkey,77)" in text
    lineitem = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_partkey" in s)
    assert "l_tax" not in lineitem and "l_extendedprice" not in lineitem
    text = plan(registry.QUERIES["fleet_daily"](spark, sf_dir))
    assert "p_brand" not in text and "p_size" not in text


@pytest.mark.parametrize("name", ["fleet_daily", "model_daily", "device_quarter", "afr_fleet_quarter", "fleet_health_30d", "device_failure", "dedupe_kept", "asof_lookback"])
def test_no_product_joins(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    if "LIKE" not in text and name not in ONE_ROW_OR_SEED:
        assert "BroadcastNestedLoopJoin" not in text


def test_all_look_backs_share_one_window(spark, sf_dir):
    """Fifteen look-back columns are one window node over one sort; the other window ranks the model patterns."""
    text = plan(registry.QUERIES["feat_drive_day"](spark, sf_dir))
    tree = text.split("== Initial Plan ==")[-1].split("\n\n")[0]
    assert len(re.findall(r"Window \(\d+\)", tree)) == 2


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES["topk_models"](spark, sf_dir))


def test_first_pattern_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(registry.QUERIES["dim_model"](spark, sf_dir))


def scans(df, column):
    """Scans in the plan that read a column of this prefix, before any exchange is reused."""
    return len(re.findall(rf"ReadSchema: struct<[^>]*\b{column}", plan(df).split("== Initial Plan ==")[-1]))


@pytest.mark.parametrize(("name", "most"), [("dim_model", 1), ("afr_fleet_quarter", 1), ("afr_fleet_year", 1), ("day_counts", 2), ("judge_days", 2), ("conflict_devices", 1), ("afr_model_quarter", 3), ("asof_lookback", 1)])
def test_facts_come_from_few_scans(spark, sf_dir, name, most):
    assert 1 <= scans(registry.QUERIES[name](spark, sf_dir), "l_") <= most


def test_look_back_is_one_sort(spark, sf_dir):
    """A window by device; no device's days meet one another in a join."""
    tree = plan(registry.QUERIES["asof_lookback"](spark, sf_dir)).split("== Initial Plan ==")[-1].split("\n\n")[0]
    assert len(re.findall(r"Window \(\d+\)", tree)) == 1 and "serial_number" not in "".join(re.findall(r"Join.*", tree))


def test_copies_are_told_apart_by_a_narrow_key(spark, sf_dir):
    """Rows are sorted and shuffled by device, day and hash, not by all their values."""
    text = plan(registry.QUERIES["dedupe_kept"](spark, sf_dir))
    for keys in re.findall(r"SortAggregate\nInput[^\n]*\nKeys \[\d+\]: \[([^\]]*)\]", text):
        assert len(keys.split(",")) <= 4


def test_casting_is_compiled_and_reads_texts_once(spark, sf_dir):
    """No filter repeats what was read before it, no array is filtered row by row in the interpreter, and methods are below the 8,000 bytes that the JVM compiles."""
    execution = registry.QUERIES["cast_detail_counts"](spark, sf_dir)._jdf.queryExecution()
    modes = spark._jvm.org.apache.spark.sql.execution.ExplainMode
    tree = execution.optimizedPlan().toString()
    assert tree.count("gettimestamp") <= 6 and "lambdafunction" not in tree
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = registry.QUERIES["cast_detail_counts"](spark, sf_dir)._jdf.queryExecution().explainString(modes.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
