"""Parameterised functions and procedures of the reference, as DataFrame operators.

Procedures that UPDATE or DELETE in the reference are frame -> frame
transitions here: they return the new table contents (and counts), and the job
layer writes them as a new snapshot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.columns import (
    avg_num, count_when, fixed, midnight, money_sum, pct, rank_desc, ts_lit,
)
from storelens.operators.dashboards import failed_access_attempts
from storelens.operators.views import customer_segments
from storelens.params import FIXTURE_FOCUS_BRANDS
from storelens.plans.scalars import with_scalars
from storelens.plans.lines import day_bounds, sales_lines, window_start, with_store
from storelens.sources.retail import Retail


def _regional_sales(r: Retail, as_of: dt.date, region: str | None, days: int) -> DataFrame:
    lines = with_store(sales_lines(r, window_start(as_of, days)), r)
    if region is not None:
        lines = lines.where(F.col("region") == region)
    rs = lines.groupBy(F.col("brand_name"), "region").agg(money_sum("line_revenue").alias("total_revenue"))
    # Region totals as a window over the (brand, region) rows, partitioned by
    # region: one pass over the item join instead of a self-join of the aggregate.
    return rs.withColumn("_market", F.sum("total_revenue").over(Window.partitionBy("region")))


def get_market_share(r: Retail, as_of: dt.date, brand: str | None = None, region: str | None = None,
                     days: int = 30) -> DataFrame:
    """Item revenue per (brand, region) and its share of the region total; the
    brand filter applies *before* the rank, as written (so a named brand always
    ranks 1). NULL parameters mean no filter."""
    rs = _regional_sales(r, as_of, region, days)
    if brand is not None:
        rs = rs.where(F.col("brand_name") == brand)
    return rs.select("brand_name", "region", "total_revenue",
                     pct("total_revenue", "_market").alias("market_share_percent"),
                     rank_desc("total_revenue", ["region"]).alias("rank_in_region"))


def market_share_ranked(r: Retail, as_of: dt.date, brand: str | None = None, region: str | None = None,
                        days: int = 30) -> DataFrame:
    """get_market_share with the rank taken over all brands of the region
    before the brand filter (the evident intent)."""
    rs = _regional_sales(r, as_of, region, days).select(
        "brand_name", "region", "total_revenue",
        pct("total_revenue", "_market").alias("market_share_percent"),
        rank_desc("total_revenue", ["region"]).alias("rank_in_region"))
    return rs.where(F.col("brand_name") == brand) if brand is not None else rs


def market_share_by_region(r: Retail, as_of: dt.date, days: int = 90,
                           focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Client (all focus brands) share of item revenue per region."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r)
    m = lines.groupBy("region").agg(
        money_sum(F.when(F.col("brand_name").isin(*focus), F.col("line_revenue")).otherwise(F.lit(0)))
        .alias("client_revenue"),
        money_sum("line_revenue").alias("total_revenue"))
    return m.withColumn("client_market_share_percent", pct("client_revenue", "total_revenue"))


def customer_insights(r: Retail, as_of: dt.date, days: int = 30, segment_params: dict | None = None) -> DataFrame:
    """Customer segments restricted to customers active in the last ``days``,
    per segment: customers, mean AOV, total spent, mean frequency. Within the
    segments' own window the last visit tells who was active."""
    params = segment_params or {}
    seg = customer_segments(r, as_of, **params)
    if days <= params.get("days", 365):
        seg = seg.where(F.col("last_transaction_date") >= ts_lit(window_start(as_of, days)))
    else:
        active = r.interactions(window_start(as_of, days)).select(F.col("customer_id").alias("_c"))
        seg = seg.join(active, F.col("customer_id") == F.col("_c"), "left_semi")
    return (seg.groupBy(F.col("customer_segment").alias("segment"))
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 fixed(F.avg("avg_transaction_value"), 2).alias("avg_transaction_value"),
                 money_sum("total_spent").alias("total_revenue"),
                 avg_num("transaction_count", 2).alias("avg_frequency")))


def flag_fmcg(r: Retail) -> DataFrame:
    """Set is_fmcg on interactions that contain at least one FMCG product and
    are not yet flagged. Returns interaction_id, is_fmcg and ``updated`` (the
    reference's ROW_COUNT is ``count(updated)``)."""
    si = r.interactions()
    if "is_fmcg" not in si.columns:
        si = si.withColumn("is_fmcg", F.lit(None).cast("boolean"))
    fmcg_products = r.products.where(F.col("is_fmcg")).select(F.col("id").alias("_p"))
    fmcg_ids = (r.transaction_items.join(fmcg_products, F.col("product_id") == F.col("_p"), "left_semi")
                .select(F.col("interaction_id").alias("_f")).distinct().withColumn("_has", F.lit(True)))
    joined = si.select("interaction_id", "is_fmcg").join(fmcg_ids, F.col("interaction_id") == F.col("_f"), "left")
    updated = F.coalesce(F.col("_has"), F.lit(False)) & (F.col("is_fmcg").isNull() | ~F.col("is_fmcg"))
    return joined.select("interaction_id",
                         F.when(updated, F.lit(True)).otherwise(F.col("is_fmcg")).alias("is_fmcg"),
                         updated.alias("updated"))


def flag_fmcg_audit(flagged: DataFrame, at: dt.datetime) -> DataFrame:
    """The audit row of a ``flag_fmcg`` run: how many interactions it flagged."""
    return flagged.agg(count_when(F.col("updated")).alias("updated_count")).select(
        F.lit("sales_interactions").alias("table_name"), F.lit("FMCG_UPDATE").alias("action"),
        F.to_json(F.struct("updated_count")).alias("new_data"), ts_lit(at).alias("audit_ts"))


def purge_audit(counts: DataFrame, at: dt.datetime) -> DataFrame:
    """The audit row of a ``purge_old_data`` run: its cut-off and counts."""
    return counts.select(F.lit("data_retention").alias("table_name"), F.lit("PURGE").alias("action"),
                         F.to_json(F.struct(*counts.columns)).alias("new_data"), ts_lit(at).alias("audit_ts"))


def purge_old_data(r: Retail, as_of: dt.date, anomalies: DataFrame, retention_months: int = 12,
                   audit_as_of: dt.date | None = None, audit_months: int = 6,
                   anomaly_months: int = 3) -> tuple[dict[str, DataFrame], DataFrame]:
    """Retention: drop items of baskets older than the cut-off (semi join),
    those baskets, audit rows older than ``audit_months`` and resolved
    anomalies resolved more than ``anomaly_months`` ago (NULL resolved_at kept).
    Returns the kept frames and a one-row frame of deleted counts."""
    cutoff = F.add_months(F.lit(as_of), -retention_months).cast("timestamp_ntz")
    audit_cut = F.add_months(F.lit(audit_as_of or as_of), -audit_months).cast("timestamp_ntz")
    anomaly_cut = F.add_months(F.lit(as_of), -anomaly_months).cast("timestamp_ntz")
    si = r.interactions()
    old = F.col("transaction_date") < cutoff
    old_ids = si.where(old).select(F.col("interaction_id").alias("_old"))
    items = r.transaction_items
    kept_items = items.join(old_ids, F.col("interaction_id") == F.col("_old"), "left_anti")
    kept_si = si.where(~old | F.col("transaction_date").isNull())
    audit_old = F.col("audit_ts") < audit_cut
    kept_audit = r.audit_log.where(~audit_old | F.col("audit_ts").isNull())
    anomaly_old = (F.col("status") == "resolved") & (F.col("resolved_at") < anomaly_cut)
    kept_anomalies = anomalies.where(~F.coalesce(anomaly_old, F.lit(False)))
    deleted_items = items.join(old_ids, F.col("interaction_id") == F.col("_old"), "left_semi") \
        .agg(F.count(F.lit(1)).alias("deleted_items"))
    counts = (with_scalars(deleted_items, si.agg(count_when(old).alias("deleted_interactions")),
                           r.audit_log.agg(count_when(audit_old).alias("deleted_audit_logs")),
                           anomalies.agg(count_when(anomaly_old).alias("deleted_anomalies")))
              .select(cutoff.cast("date").alias("cutoff_date"), "deleted_items", "deleted_interactions",
                      "deleted_audit_logs", "deleted_anomalies"))
    kept = {"transaction_items": kept_items, "sales_interactions": kept_si, "audit_log": kept_audit,
            "anomalies": kept_anomalies}
    return kept, counts


def system_alerts(r: Retail, as_of: dt.date, anomalies: DataFrame, min_idle_stores: int = 5,
                  max_high_anomalies: int = 10) -> DataFrame:
    """UNION ALL of three global-HAVING counts: stale devices (> 0), stores
    without a sale today (> min_idle_stores), active high anomalies
    (> max_high_anomalies). Each branch yields one row or none."""
    stale = r.device_master.where(F.col("last_seen") < ts_lit(midnight(as_of) - dt.timedelta(hours=24)))
    t0, t1 = day_bounds(as_of)
    sold_today = r.interactions(t0, t1).select(F.col("store_id").alias("_s"))
    idle = r.stores.join(sold_today, F.col("id") == F.col("_s"), "left_anti")
    high = anomalies.where((F.col("status") == "active") & (F.col("severity") == "high"))

    def branch(df: DataFrame, alert: str, severity: str, message: str, floor: int) -> DataFrame:
        return (df.agg(F.count(F.lit(1)).cast("int").alias("affected_count"))
                .where(F.col("affected_count") > floor)
                .select(F.lit(alert).alias("alert_type"), F.lit(severity).alias("severity"),
                        F.lit(message).alias("message"), "affected_count"))

    return (branch(stale, "DEVICE_CONNECTIVITY", "high", "Devices offline for more than 24 hours", 0)
            .unionByName(branch(idle, "REVENUE_ANOMALY", "medium", "Stores with zero revenue today", min_idle_stores))
            .unionByName(branch(high, "ANOMALY_COUNT", "high", "High number of active anomalies",
                                max_high_anomalies)))


def alert_payload(alerts: DataFrame, as_of: dt.date) -> DataFrame:
    """One audit row holding all alerts as a JSON array (NULL when none). The
    alert set has at most three rows, so collecting it into one value is bounded.
    The array is sorted (by alert type first), so the payload is deterministic."""
    agg = alerts.agg(F.array_sort(F.collect_list(F.struct(*alerts.columns))).alias("_a"))
    return agg.select(F.lit("system_alerts").alias("table_name"), F.lit("ALERT_CHECK").alias("action"),
                      F.when(F.size("_a") > 0, F.to_json("_a")).alias("new_data"),
                      ts_lit(as_of).alias("audit_ts"))


def security_alert(r: Retail, as_of: dt.datetime, hours: int = 24, min_attempts: int = 5,
                   threshold: int = 10) -> DataFrame:
    """One row: the number of (ip, agent) pairs with more than ``threshold``
    failed attempts in the failed-access view (0 when none)."""
    fa = failed_access_attempts(r, as_of, hours, min_attempts)
    return fa.agg(count_when(F.col("attempt_count") > threshold).alias("suspicious_ips")).select(
        F.lit("SECURITY_ALERT").alias("type"), "suspicious_ips", F.lit("high").alias("severity"))


def hash_sensitive(c: str | F.Column) -> F.Column:
    """SHA-256 hex digest of the text value (NULL stays NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(col.cast("string"), 256)
