"""Invariants from SURVEY §5.2 on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from storelens.operators import access, anomalies
from storelens.registry import AS_OF, HV, SB, SP
from storelens.sources.retail import Retail
from tests.conftest import SMOKE_DIR

QUERIES = entry.queries()


def _dupes(df, keys):
    return df.groupBy(*keys).count().where("count > 1").count()


def test_grains_are_unique(spark):
    grains = {
        "daily_sales": ["sale_date", "store_id", "day_of_week", "peak_hour"],
        "product_performance": ["product_id"],
        "brand_competition": ["brand_name"],
        "regional_performance": ["region"],
        "philippine_market_analysis": ["region"],
        "category_performance": ["category"],
        "daily_sales_summary": ["sale_date", "region", "store_type", "brand_name", "category"],
    }
    for key, cols in grains.items():
        assert _dupes(QUERIES[key](spark, SMOKE_DIR), cols) == 0, key


def test_category_shares_sum_to_100(spark):
    df = QUERIES["brand_competition"](spark, SMOKE_DIR)
    for row in df.groupBy("brand_category").agg(F.sum("category_market_share_percent").alias("s")).collect():
        assert abs(row["s"] - 100.0) < 0.1


def test_client_plus_competitor_is_total(spark):
    for row in QUERIES["category_performance"](spark, SMOKE_DIR).collect():
        assert row["client_revenue"] + row["competitor_revenue"] == row["total_revenue"]


def test_dedup_revenue_is_plain_basket_sum(spark):
    r = Retail.for_dir(spark, SMOKE_DIR)
    start = dt.datetime(2001, 5, 3)
    dedup = QUERIES["regional_performance_dedup"](spark, SMOKE_DIR).agg(F.sum("total_revenue")).first()[0]
    plain = r.interactions(start).agg(F.sum("total_amount")).first()[0]
    assert dedup == plain
    written = QUERIES["regional_performance"](spark, SMOKE_DIR).agg(F.sum("total_revenue")).first()[0]
    assert written >= dedup  # as written, baskets repeat once per item row


def test_policy_result_is_subset(spark):
    r = Retail.for_dir(spark, SMOKE_DIR)
    si = r.interactions()
    seen = access.apply_policy(si, "sales_interactions", "store_manager", r=r, user_id=7, hour=22, as_of=AS_OF,
                               grants=access.derived_grants(r))
    assert seen.join(si, "interaction_id", "left_anti").count() == 0


def test_detection_state_resolves_previous_run(spark):
    r = Retail.for_dir(spark, SMOKE_DIR)
    first = anomalies.detected_anomalies(r, AS_OF, high_value=HV, store_pattern=SP, substitution=SB)
    state, audit = anomalies.detect_anomalies(r, AS_OF, existing=first, run_ts=dt.datetime(2001, 8, 2),
                                              high_value=HV, store_pattern=SP, substitution=SB)
    counts = {row["status"]: row["count"] for row in state.groupBy("status").count().collect()}
    n = first.count()
    assert counts.get("resolved", 0) == n and counts.get("active", 0) == n
    assert audit.count() == 1
    assert state.select("id").distinct().count() == 2 * n  # ids differ between runs
    again, _ = anomalies.detect_anomalies(r, AS_OF, existing=state, run_ts=dt.datetime(2001, 8, 2),
                                          high_value=HV, store_pattern=SP, substitution=SB)
    assert again.exceptAll(state).count() == state.exceptAll(again).count() == 0  # a rerun of a run changes nothing


def test_detection_job_keeps_state_and_audit(spark, tmp_path):
    import json

    from storelens import jobs

    r, base = Retail.for_dir(spark, SMOKE_DIR), str(tmp_path / "state")
    rules = dict(high_value=HV, store_pattern=SP, substitution=SB)
    first = jobs.detection_run(spark, r, base, AS_OF, dt.datetime(2001, 8, 1), **rules).count()
    second = jobs.detection_run(spark, r, base, AS_OF, dt.datetime(2001, 8, 2), **rules)
    assert second.where("status = 'resolved'").count() == second.where("status = 'active'").count() == first
    audit = [json.loads(x["new_data"]) for x in spark.read.parquet(f"{base}/_audit").where("action = 'DETECTION_RUN'").collect()]
    assert len(audit) == 2 and all(a["high_value_threshold"] > 0 for a in audit)


def test_nightly_export_rerun(spark, tmp_path):
    from storelens import jobs

    r, base = Retail.for_dir(spark, SMOKE_DIR), str(tmp_path / "export")
    day = r.interactions().agg({"transaction_date": "max"}).first()[0].date()
    n = jobs.nightly_export(r, base, day).count()
    assert jobs.nightly_export(r, base, day).count() == n > 0


def test_refresh_run_equals_direct_views(spark, tmp_path):
    from storelens import jobs
    from storelens.registry import REFRESH_PARAMS

    r = Retail.for_dir(spark, SMOKE_DIR)
    manifest = jobs.refresh_analytics(spark, r, str(tmp_path / "refresh"), AS_OF, REFRESH_PARAMS)
    paths = {row["name"]: row["path"] for row in manifest.collect()}
    direct = jobs.stored_views(AS_OF, REFRESH_PARAMS)
    assert set(paths) == set(direct)
    for name in direct:
        stored = spark.read.parquet(paths[name])
        fresh = direct[name](r)
        assert stored.exceptAll(fresh.select(*stored.columns)).count() == 0, name
        assert fresh.select(*stored.columns).exceptAll(stored).count() == 0, name


def test_entry_under_non_utc_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Manila")
    try:
        rows = {r["day"]: r["transactions"] for r in QUERIES["daily_revenue"](spark, SMOKE_DIR)
                .withColumnRenamed("date", "day").collect()}
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert sum(rows.values()) == Retail.for_dir(spark, SMOKE_DIR).interactions().count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
