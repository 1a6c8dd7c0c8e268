"""Physical-plan checks: pushdown, broadcast of bounded dims, single pass over
the item join, no multi-distinct Expand in the flagship, no cartesian products."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from storelens.plans.broadcast import size_checked_broadcast
from storelens.sources.retail import Retail
from tests.conftest import SMOKE_DIR

QUERIES = entry.queries()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = QUERIES["brand_competition"](spark, SMOKE_DIR)
    plan = plan_text(df)
    assert "Expand" not in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan  # window bound reaches the orders scan
    assert "BroadcastExchange" in plan
    assert plan.count("lineitem.parquet") == 1  # the item join is computed once


def test_product_rank_is_not_sorted_by_category(spark):
    """Products are never dealt to tasks by category alone, and nothing runs while the plan is built."""
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = QUERIES["product_performance"](spark, SMOKE_DIR)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    plan = plan_text(df)
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("product_id" in w for w in windows)
    assert "Scan ExistingRDD" not in plan


def test_category_performance_never_expands(spark):
    assert "Expand" not in plan_text(QUERIES["category_performance"](spark, SMOKE_DIR))


def test_product_total_is_summed_from_categories(spark):
    """The one window over all rows reads a row per category; products and numbers sold are in none."""
    plan = plan_text(QUERIES["product_performance"](spark, SMOKE_DIR))
    windows = [line.split("Window [")[1] for line in plan.splitlines() if "Window [" in line]
    whole = [w for w in windows if "], [category" not in w]
    assert len(windows) == 2 and len(whole) == 1 and "_of_category" in whole[0]
    assert plan.count("lineitem.parquet") <= 2


def test_regional_customers_are_bitmaps(spark):
    plan = plan_text(QUERIES["regional_performance"](spark, SMOKE_DIR))
    assert "Expand" not in plan and "bitmap" in plan and plan.count("lineitem.parquet") == 1


def test_dedup_dashboard_joins_the_items_once(spark):
    plain, dedup = (plan_text(QUERIES[k](spark, SMOKE_DIR)) for k in ("executive_dashboard", "executive_dashboard_dedup"))
    # a subquery is shown once for each of its columns: one column more, no other join of the items
    assert dedup.count("lineitem.parquet") == plain.count("lineitem.parquet") + 1


@pytest.mark.parametrize("key", ["category_performance", "get_market_share_all", "focus_brand_by_region",
                                 "brand_mix", "philippine_market_analysis", "focus_brand_performance"])
def test_item_join_scanned_once(spark, key):
    plan = plan_text(QUERIES[key](spark, SMOKE_DIR))
    assert plan.count("lineitem.parquet") <= 1, key


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("export", "raw_", "file_", "lake_",
                                                                                 "snapshot", "stream", "cdc_route",
                                                                                 "live_", "metric_threshold",
                                                                                 "error_burst", "rate_limit"))))
def test_no_cartesian_product(spark, key):
    plan = plan_text(QUERIES[key](spark, SMOKE_DIR))
    assert "CartesianProduct" not in plan, key
    assert "BroadcastNestedLoopJoin" not in plan, key


def test_scan_prunes_columns(spark):
    plan = plan_text(QUERIES["daily_sales"](spark, SMOKE_DIR))
    orders_scan = [line for line in plan.splitlines() if "orders.parquet" in line][0]
    assert "o_comment" not in orders_scan and "o_totalprice" in orders_scan


def test_size_checked_broadcast_respects_limit(spark):
    r = Retail.for_dir(spark, SMOKE_DIR)
    small = size_checked_broadcast(r.stores)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower() or \
        "BroadcastExchange" in plan_text(small.join(r.raw("orders"), small.id == r.raw("orders").o_custkey))
    unchanged = size_checked_broadcast(r.raw("lineitem"), max_bytes=1)
    assert unchanged is r.raw("lineitem")
