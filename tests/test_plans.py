"""Shapes of the physical plans: what must not appear in any registered query."""

import os
import re

import pytest

from oracle_check import tables_at
from shapes import plan_of
from tillroll.queries import QUERIES

SF_DIR = tables_at("0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def physical(df):
    return plan_of(df).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("key", QUERIES)
def test_no_query_pairs_or_gathers_rows(spark, key):
    plan = physical(QUERIES[key](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan
    # One task only for results of a known size: global aggregates and the top 50.
    for exchange in re.finditer(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "Aggregate(keys=[]" in exchange.group(1)
    if "Window" in plan:
        assert "TakeOrderedAndProject(limit=50" in plan


@pytest.mark.parametrize(
    "key, columns",
    [
        ("event_lines", "event_id:bigint,user_id:bigint,event_type:string,value:double"),
        ("notification_keys", "event_id:bigint,event_type:string"),
        ("monthly_revenue", "o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz"),
    ],
)
def test_scans_read_only_needed_columns(spark, key, columns):
    assert f"ReadSchema: struct<{columns}>" in physical(QUERIES[key](spark, SF_DIR))


def test_cleaning_filters_reach_the_scan(spark):
    plan = physical(QUERIES["clean_orders"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^]]*l_orderkey", plan)


def test_text_is_grouped_not_buffered(spark):
    """Sorting aggregates only see rows already reduced by a hash aggregate."""
    for key in ("daily_revenue", "monthly_revenue", "customer_rfm", "loyalty_tier_counts"):
        assert "SortAggregate" not in physical(QUERIES[key](spark, SF_DIR))
    plan = physical(QUERIES["top_products"](spark, SF_DIR))
    lowest = plan.rindex("SortAggregate")
    assert "HashAggregate(keys=[StockCode" in plan[lowest:]


def test_the_generations_filter_the_order_scan(spark):
    for key in ("schema_evolution", "union_parts", "loyalty_tier_counts"):
        plan = physical(QUERIES[key](spark, SF_DIR))
        assert len(re.findall(r"PushedFilters: \[[^]]*o_orderdate", plan)) >= 2
        assert re.search(r"(GreaterThanOrEqual|LessThan)\(o_orderdate,2000-01-01", plan)


def test_scores_need_no_shuffle_and_no_lists(spark):
    plan = physical(QUERIES["customer_segments"](spark, SF_DIR))
    assert not re.search("Exchange|Window|collect_list", plan)


def test_the_trend_sorts_months_only(spark):
    plan = physical(QUERIES["revenue_trend"](spark, SF_DIR))
    assert plan.count("rangepartitioning") == 1
