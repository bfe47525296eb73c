"""What the plans must look like to hold on a large table."""

import re

import __spark_entry__  # noqa: F401
import pytest
from pyspark.sql import functions as F

from scorewatch.operators import series
from scorewatch.plans.registry import QUERIES, scored_events

# These write files or fit models, so that their plan only reads the outcome.
EAGER = {n for n in QUERIES if n.startswith(("stream_", "live_", "history_", "csv_"))}
# Matrix products over Arrow batches.
PYTHON = {n for n in QUERIES if "correlation" in n and n != "correlation_few_columns"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInArrow" in plan) == (name in PYTHON)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("points_2d", {"l_quantity", "l_extendedprice", "l_discount"}),
        ("hourly_pattern", {"ts", "value"}),
        ("weighted_histogram", {"l_quantity", "l_extendedprice", "l_returnflag"}),
        ("row_count", set()),
        ("category_share", {"p_type"}),
    ],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, sf_dir)))
    assert {c.split(":")[0] for r in read for c in r.split(",") if c} == columns


@pytest.mark.parametrize("name", ["since", "recent_series_until", "cohort_filter"])
def test_filters_reach_the_scan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any(re.search("Greater|Less|In", p) for p in pushed), pushed


@pytest.mark.parametrize("name", ["last_n", "recent_predictions"])
def test_newest_rows_are_cut_in_each_task(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["last_n_per_user", "last_n_per_type"])
def test_rank_is_limited_before_the_shuffle(spark, sf_dir, name):
    """A hot key sends n rows per task, not all of them; above Spark's own limit ranges are counted."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert ("WindowGroupLimit" in plan) != ("_ordered_part" in plan)


def test_split_work_never_sorts_a_whole_key(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    plan = plan_of(series.with_delta(scored, ["event_type"], ["ts", "event_id"], "value", ranges=8))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    # One inside (partition, key), one over the two rows at the ends of every partition. The only
    # join is with the latter.
    assert len(windows) == 2 and sum("_ordered_part" in w for w in windows) == 1
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1


def test_totals_use_partial_aggregates(spark, sf_dir):
    for name in ("summary", "histogram", "confusion", "cohort_counts", "missing_report"):
        assert "partial_" in plan_of(QUERIES[name](spark, sf_dir)), name


def test_a_dimension_too_large_to_broadcast_is_merged(spark, sf_dir):
    """The join is left to Spark: by size it broadcasts, or sorts and splits skewed partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["enriched_records"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
