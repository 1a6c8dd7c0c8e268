"""Scheduled jobs: one refresh run of all stored views (reference refresh
procedures), the anomaly detection run, and the nightly export.

A refresh run computes the item-level sales join once for the widest window
any view needs, stored as parquet in the shared folder; views
with narrower windows filter it. Each view is then written as a new snapshot
version with START / COMPLETE / ERROR audit rows.
"""

from __future__ import annotations

import copy
import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import anomalies, dashboards, views
from storelens.plans.lines import day_bounds, sales_lines, window_start
from storelens.plans.materialize import materialize
from storelens.sources import sinks
from storelens.sources.retail import Retail


def with_shared_lines(r: Retail, start: dt.datetime) -> Retail:
    """A view of ``r`` whose inner item join from ``start`` on is computed
    once and reused by every operator asking for a window inside it."""
    lines = materialize(sales_lines(r, start))
    shared = copy.copy(r)
    shared.shared_lines = (start, lines)
    return shared


def stored_views(as_of: dt.date, params: dict | None = None) -> dict[str, Callable[[Retail], DataFrame]]:
    """The reference's materialised views with their windows (and fixture or
    production parameters)."""
    p = params or {}

    def found(r: Retail) -> DataFrame:
        return anomalies.detected_anomalies(r, as_of, **p.get("anomalies", {}))

    return {
        "daily_sales": lambda r: views.daily_sales(r, as_of, 90),
        "product_performance": lambda r: views.product_performance(r, as_of, 90, **p.get("product_performance", {})),
        "regional_performance": lambda r: views.regional_performance(r, as_of, 90),
        "philippine_market_analysis": lambda r: views.philippine_market_analysis(r, as_of, 90),
        "focus_brand_performance_view": lambda r: views.focus_brand_performance(r, as_of, 90),
        "brand_competition_dashboard": lambda r: views.brand_competition(r, as_of, 30),
        "category_performance_analytics": lambda r: views.category_performance(r, as_of, 30),
        "mv_daily_sales_summary": lambda r: views.daily_sales_summary(r, as_of, 90),
        "mv_executive_kpis": lambda r: views.executive_kpis(r, as_of, 30),
        "store_performance_dashboard": lambda r: dashboards.store_performance_dashboard(
            r, as_of, 30, **p.get("store_performance_dashboard", {})),
        "customer_analytics_dashboard": lambda r: dashboards.customer_analytics(
            r, as_of, 30, **p.get("customer_analytics", {})),
        "hourly_sales_patterns": lambda r: dashboards.hourly_sales_patterns(r, as_of, 30),
        "executive_dashboard": lambda r: dashboards.executive_dashboard(r, as_of, found(r)),
        "system_health_dashboard": lambda r: dashboards.system_health(r, as_of, found(r)),
    }


def refresh_analytics(spark: SparkSession, r: Retail, out_base: str, as_of: dt.date, params: dict | None = None,
                      now: dt.datetime | None = None, share_lines: bool = True) -> DataFrame:
    """Refresh every stored view as a new snapshot version; returns the
    manifest rows of this run (name, version, path, rows, duration)."""
    now = now or dt.datetime.combine(as_of, dt.time())
    views_to_build = stored_views(as_of, params)
    sinks._audit(spark, out_base, "all", "REFRESH_START", json.dumps({"views": len(views_to_build)}), now)
    run = with_shared_lines(r, window_start(as_of, 90)) if share_lines else r
    written = [sinks.write_version(spark, out_base, name, build(run), now) for name, build in views_to_build.items()]
    # One manifest append for the run: all views switch to the new versions together.
    return sinks.publish_versions(spark, out_base, written, now)


def detection_run(spark: SparkSession, r: Retail, base: str, as_of: dt.date, run_ts: dt.datetime | None = None,
                  **rule_params) -> DataFrame:
    """One anomaly detection run over the stored state under ``base``: the state becomes a new snapshot version of
    ``anomalies`` and the run's audit row is appended. Returns the stored state. A rerun of one ``run_ts`` gives
    the same rows."""
    now = run_ts or dt.datetime.combine(as_of, dt.time())
    last = sinks.latest_snapshot(spark, base, "anomalies")
    row = last.first() if last is not None else None
    existing = spark.read.parquet(row["path"]) if row is not None else None
    state, audit = anomalies.detect_anomalies(r, as_of, existing=existing, run_ts=now, **rule_params)
    written = sinks.write_version(spark, base, "anomalies", state, now)
    sinks.publish_versions(spark, base, [written], now)
    sinks.append_history(audit.select("table_name", "action", "new_data", F.col("audit_ts").cast("timestamp").alias("audit_ts")),
                         base, "_audit")
    return spark.read.parquet(written[2])


def nightly_export(r: Retail, base: str, day: dt.date) -> DataFrame:
    """The baskets of ``day`` as a parquet export under ``base`` (a rerun replaces the day's export)."""
    start, end = day_bounds(day)
    return sinks.export_transactions(r.interactions(start, end), f"{base.rstrip('/')}/transactions/run={day.isoformat()}")
