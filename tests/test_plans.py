"""Plan checks over all registered queries: no Python, no row-pair joins, pruned scans."""

import re

import pytest

from checks import registry
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
# Queries that read back what a stream or a whole run has written have no plan of interest.
WRITTEN = ("t1_route_stream", "t7_stream_events", "q13_empty_load", "e4_stream_enriched", "q6_run_report",
           "d17_run_counts", "live_v3_unique", "live_m7_pairs")
BATCH = [n for n in registry.QUERIES if n not in WRITTEN and not n.startswith("s")]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(registry.QUERIES[name](spark, SF_DIR)) for name in BATCH}


def test_no_python_in_any_plan(plans):
    for name, plan in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", plan), name


def test_no_cross_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_no_expanded_distinct_in_marts(plans):
    for name, plan in plans.items():
        if re.match(r"(m|pub_m)\d", name):
            assert "Expand" not in plan, name


def test_scans_read_the_needed_columns_only(plans):
    scan = re.search(r"ReadSchema: struct<(.*?)>", plans["m5_active_users_7d"]).group(1)
    assert "value" not in scan and "props" not in scan
    for plan in plans.values():
        assert "l_comment" not in plan and "props" not in plan.split("ReadSchema")[-1]


def test_first_per_key_queries_are_limited_before_the_shuffle(plans):
    for name in ("v3_dedup", "d4_orders_latest_status", "d6_upsert_orders", "d14_campaigns"):
        assert re.search(r"WindowGroupLimit.*Partial", plans[name]), name


def test_large_tables_are_never_sorted_in_one_task(plans):
    """A window without partition may only run over rows per day or per group."""
    for name, plan in plans.items():
        if "Exchange SinglePartition" in plan and "Window" in plan and name[0] in "mdv":
            single = plan[plan.index("Exchange SinglePartition"):].splitlines()[1]
            assert "Aggregate" in single, name


def test_campaign_rows_move_once_by_user(plans):
    for name in ("m7_campaign_performance", "m7_campaign_performance_safe"):
        assert plans[name].count("Exchange hashpartitioning(user_id") == 1, name
        assert plans[name].count("Exchange hashpartitioning") <= 3, name
