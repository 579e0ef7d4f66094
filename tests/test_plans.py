"""Plan properties the design relies on (checked on the optimized physical plans)."""

import re

import pytest

from revlens.plans.registry import REGISTRY
from tests.conftest import SF001

def _plan(spark, name):
    df = REGISTRY[name][0](spark, SF001)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _nodes(plan, name):
    return len(re.findall(rf"^\(\d+\) {name}\b", plan, flags=re.M))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_per_key_top_k_is_limited_before_the_shuffle(spark):
    plan = _plan(spark, "latest_reviews")
    tree = plan.split("\n\n")[0]
    # WindowGroupLimit (partial) below the Exchange, and a final one above it
    assert _nodes(plan, "WindowGroupLimit") == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


@pytest.mark.parametrize("name", ["popular_products", "top_rated", "trending_products"])
def test_rankings_use_take_ordered(spark, name):
    plan = _plan(spark, name)
    assert _nodes(plan, "TakeOrderedAndProject") == 1
    assert _nodes(plan, "Sort") == 0  # no full sort


def test_sample_sorts_bucket_counts_only(spark):
    """The rows go through a top-n; the one Sort is that of the running sum over at most 65,536 bucket counts."""
    plan = _plan(spark, "export_sample")
    assert _nodes(plan, "TakeOrderedAndProject") == 1
    assert _nodes(plan, "Sort") == 1 and _nodes(plan, "Window") == 1


def test_period_filter_reaches_the_scan(spark):
    plan = _plan(spark, "trending_products")
    pushed = re.search(r"^PushedFilters: \[(.*)\]$", plan, flags=re.M).group(1)
    assert "GreaterThanOrEqual(review_time" in pushed and "LessThanOrEqual(review_time" in pushed


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "rating_histogram")
    schema = re.search(r"^ReadSchema: struct<(.*)>$", plan, flags=re.M).group(1)
    assert "review_text" not in schema and "title" not in schema


def test_score_helper_runs_once_per_title(spark):
    plan = _plan(spark, "similar_titles")
    assert _nodes(plan, "ArrowEvalPython") == 1
    assert _nodes(plan, "HashAggregate") == 0  # over the stored catalogue, a row per title
