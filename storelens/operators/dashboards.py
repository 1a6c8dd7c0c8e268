"""Live dashboard and monitoring views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import (
    as_double, avg_money, count_distinct, count_if, count_when, dow, fixed, hour, midnight, money_sum, pct, ts_lit,
)
from storelens.operators.views import growth_pct
from storelens.params import FIXTURE_FOCUS_BRANDS
from storelens.plans.scalars import with_scalars
from storelens.plans.lines import day_bounds, sales_lines, window_start, with_mega_region, with_store
from storelens.sources.retail import Retail


def executive_dashboard(r: Retail, as_of: dt.date, anomalies: DataFrame,
                        focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS, dedup: bool = False) -> DataFrame:
    """One row: today / yesterday / 7-day blocks from one conditional pass over
    the baskets of the last 7 days; the 30-day block over item rows (basket sums
    fanned out per item as written); client share of item revenue; counts of
    active anomalies and of active / non-active devices (NULL status in neither).
    With ``dedup`` also the 30-day revenue with each basket's amount once."""
    t0, t1 = day_bounds(as_of)
    y0 = t0 - dt.timedelta(days=1)
    week = r.interactions(window_start(as_of, 7))
    ts = F.col("transaction_date")
    is_today = (ts >= ts_lit(t0)) & (ts < ts_lit(t1))
    is_yday = (ts >= ts_lit(y0)) & (ts < ts_lit(t0))
    amt = F.col("total_amount")
    # interaction_id is the key of sales_interactions: COUNT(DISTINCT id) = COUNT(id).
    short = week.agg(
        F.count(F.when(is_today, F.col("interaction_id"))).alias("total_transactions_today"),
        money_sum(F.when(is_today, amt)).alias("revenue_today"),
        count_distinct(F.when(is_today, F.col("store_id"))).alias("active_stores_today"),
        avg_money(F.when(is_today, amt)).alias("avg_transaction_today"),
        money_sum(F.when(is_yday, amt)).alias("revenue_yesterday"),
        F.count(F.col("interaction_id")).alias("transactions_7d"),
        money_sum(amt).alias("revenue_7d"),
        count_distinct("customer_id").alias("unique_customers_7d"))
    focus_flag = F.col("brand_name").isin(*focus)
    # Items reduced per basket first (the join output is already partitioned
    # by basket): basket amounts are summed once per item row as written,
    # and only the customer count stays distinct.
    per_basket = (sales_lines(r, window_start(as_of, 30))
                  .groupBy("interaction_id", "customer_id", "total_amount")
                  .agg(F.count(F.lit(1)).alias("_n"),
                       F.sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_client"),
                       F.sum(F.when(~focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_comp")))
    month = per_basket.agg(
        F.count(F.lit(1)).alias("transactions_30d"),
        money_sum(F.col("total_amount") * F.col("_n")).alias("revenue_30d"),
        count_distinct("customer_id").alias("unique_customers_30d"),
        money_sum("_client").alias("client_revenue_30d"),
        money_sum("_comp").alias("competitor_revenue_30d"),
        *([money_sum("total_amount").alias("revenue_30d_dedup")] if dedup else []))
    anom = anomalies.agg(count_when(F.col("status") == "active").alias("active_anomalies"))
    dev = r.device_master.agg(count_when(F.col("status") == "active").alias("active_devices"),
                              count_when(F.col("status") != "active").alias("inactive_devices"))
    client = F.col("client_revenue_30d")
    return (with_scalars(short, month, anom, dev)
            .select(F.lit(as_of).alias("dashboard_date"), "total_transactions_today", "revenue_today",
                    "active_stores_today", "avg_transaction_today",
                    growth_pct("revenue_today", "revenue_yesterday").alias("revenue_growth_dod_percent"),
                    "transactions_7d", "revenue_7d", "unique_customers_7d", "transactions_30d", "revenue_30d",
                    "unique_customers_30d", "client_revenue_30d", "competitor_revenue_30d",
                    pct(client, client + F.col("competitor_revenue_30d")).alias("client_market_share_percent"),
                    "active_anomalies", "active_devices", "inactive_devices",
                    *(["revenue_30d_dedup"] if dedup else [])))


def store_performance_dashboard(r: Retail, as_of: dt.date, days: int = 30,
                                tiers: tuple[float, float, float] = (50000, 25000, 10000),
                                focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Every store (idle ones too) x its device (status, last_seen) groups.

    As written the reference LEFT JOINs items and then devices, so basket sums
    repeat once per item row *and* once per device of the store. Rather than
    materialising that product, store metrics are aggregated once and the sums
    are multiplied by the number of devices in the (status, last_seen) group;
    counts of distinct values and averages are unchanged by the repetition.
    """
    lines = sales_lines(r, window_start(as_of, days), how="left")
    focus_flag = F.col("brand_name").isin(*focus)
    # Items reduced per basket first; basket values then count once per item
    # row (weight _n, a LEFT join keeps item-less baskets as one row).
    per_basket = (lines.groupBy("store_id", "interaction_id", "customer_id", "total_amount",
                                "is_attendant_influenced", "substitution_occurred")
                  .agg(F.count(F.lit(1)).alias("_n"),
                       F.sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_tb")))
    n_rows = F.col("_n")
    per_store = (per_basket.groupBy(F.col("store_id").alias("_m_store"))
                 .agg(F.count(F.lit(1)).alias("_tx"),
                      money_sum(F.col("total_amount") * n_rows).alias("_rev"),
                      (F.sum(F.col("total_amount") * n_rows) / F.sum(F.when(F.col("total_amount").isNotNull(), n_rows)))
                      .alias("_avg"),
                      count_distinct("customer_id").alias("_cust"),
                      F.sum(F.when(F.col("is_attendant_influenced"), n_rows).otherwise(0)).cast("long").alias("_infl"),
                      F.sum(F.when(F.col("substitution_occurred"), n_rows).otherwise(0)).cast("long").alias("_subs"),
                      money_sum("_tb").alias("_client")))
    devices = (r.device_master.groupBy(F.col("store_id").alias("_d_store"), "status", "last_seen")
               .agg(F.count(F.lit(1)).alias("_n")))
    stores = r.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"), "region",
                             "store_type")
    base = (stores.join(per_store, F.col("store_id") == F.col("_m_store"), "left")
            .join(devices, F.col("store_id") == F.col("_d_store"), "left"))
    n = F.coalesce(F.col("_n"), F.lit(1))
    rev = (F.col("_rev") * n).cast("decimal(38,2)")
    tx = F.coalesce(F.col("_tx"), F.lit(0)).cast("long")
    infl = F.coalesce(F.col("_infl"), F.lit(0)) * n
    subs = F.coalesce(F.col("_subs"), F.lit(0)) * n
    client = (F.coalesce(F.col("_client"), F.lit(0)) * n).cast("decimal(38,2)")
    out = base.select(
        "store_id", "store_name", "region", "store_type",
        tx.alias("transactions_30d"), rev.alias("revenue_30d"), fixed("_avg", 6).alias("avg_transaction_value"),
        F.coalesce(F.col("_cust"), F.lit(0)).cast("long").alias("unique_customers_30d"),
        pct(infl, tx).alias("influence_rate_percent"), pct(subs, tx).alias("substitution_rate_percent"),
        F.col("status").alias("device_status"), "last_seen", client.alias("client_revenue"),
        pct(client, rev).alias("client_share_percent"),
        F.when(rev >= tiers[0], "Top Performer").when(rev >= tiers[1], "Strong Performer")
        .when(rev >= tiers[2], "Average Performer").when(rev > 0, "Underperformer")
        .otherwise("No Activity").alias("performance_tier"),
        F.when(F.col("status") != "active", F.lit("Device Issue")).alias("device_alert"),
        F.when(F.col("last_seen") < ts_lit(midnight(as_of) - dt.timedelta(hours=24)), F.lit("Connectivity Issue"))
        .alias("connectivity_alert"))
    return out.orderBy(F.col("revenue_30d").desc_nulls_last())


def store_performance_dashboard_dedup(r: Retail, as_of: dt.date, days: int = 30,
                                      tiers: tuple[float, float, float] = (50000, 25000, 10000),
                                      focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """One row per store with basket metrics counted once per basket (no item
    or device repetition); device columns summarise the store's devices:
    device_count, active_devices, newest last_seen."""
    start = window_start(as_of, days)
    si = r.interactions(start)
    focus_flag = F.col("brand_name").isin(*focus)
    client = (sales_lines(r, interactions=si.select("interaction_id"))
            .groupBy(F.col("interaction_id").alias("_b"))
            .agg(F.sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_client_b")))
    baskets = si.join(client, F.col("interaction_id") == F.col("_b"), "left")
    per_store = (baskets.groupBy(F.col("store_id").alias("_m_store"))
                 .agg(F.count(F.lit(1)).alias("_tx"), money_sum("total_amount").alias("_rev"),
                      F.avg("total_amount").alias("_avg"), count_distinct("customer_id").alias("_cust"),
                      count_if(F.col("is_attendant_influenced")).alias("_infl"),
                      count_if(F.col("substitution_occurred")).alias("_subs"),
                      money_sum(F.coalesce(F.col("_client_b"), F.lit(0))).alias("_client")))
    devices = (r.device_master.groupBy(F.col("store_id").alias("_d_store"))
               .agg(F.count(F.lit(1)).alias("device_count"), count_when(F.col("status") == "active")
                    .alias("active_devices"), F.max("last_seen").alias("last_seen")))
    stores = r.stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"), "region",
                             "store_type")
    base = (stores.join(per_store, F.col("store_id") == F.col("_m_store"), "left")
            .join(devices, F.col("store_id") == F.col("_d_store"), "left"))
    tx = F.coalesce(F.col("_tx"), F.lit(0)).cast("long")
    rev = F.col("_rev")
    tb = F.coalesce(F.col("_client"), F.lit(0)).cast("decimal(38,2)")
    return base.select(
        "store_id", "store_name", "region", "store_type", tx.alias("transactions_30d"), rev.alias("revenue_30d"),
        fixed("_avg", 6).alias("avg_transaction_value"),
        F.coalesce(F.col("_cust"), F.lit(0)).cast("long").alias("unique_customers_30d"),
        pct(F.coalesce(F.col("_infl"), F.lit(0)), tx).alias("influence_rate_percent"),
        pct(F.coalesce(F.col("_subs"), F.lit(0)), tx).alias("substitution_rate_percent"),
        F.coalesce(F.col("device_count"), F.lit(0)).cast("long").alias("device_count"),
        F.coalesce(F.col("active_devices"), F.lit(0)).cast("long").alias("active_devices"), "last_seen",
        tb.alias("client_revenue"), pct(tb, rev).alias("client_share_percent"),
        F.when(rev >= tiers[0], "Top Performer").when(rev >= tiers[1], "Strong Performer")
        .when(rev >= tiers[2], "Average Performer").when(rev > 0, "Underperformer")
        .otherwise("No Activity").alias("performance_tier"))


def executive_dashboard_dedup(r: Retail, as_of: dt.date, anomalies: DataFrame,
                              focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """executive_dashboard with the 30-day basket revenue counted once per
    basket (baskets with at least one item, as the inner join requires)."""
    return executive_dashboard(r, as_of, anomalies, focus, dedup=True)


def _age_group(age: F.Column) -> F.Column:
    bands = [(18, 25), (26, 35), (36, 45), (46, 55), (56, 65)]
    expr = None
    for lo, hi in bands:
        cond = age.between(lo, hi)
        label = F.lit(f"{lo}-{hi}")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit("65+"))


def customer_analytics(r: Retail, as_of: dt.date, days: int = 30,
                       value_cuts: tuple[float, float] = (200, 100),
                       minute_cuts: tuple[float, float] = (5, 2)) -> DataFrame:
    """Per (gender, age group, emotion, region, mega region) over ``days``:
    count, spend, mean basket, mean minutes, influence and substitution %,
    value segment and shopper type (age < 18 and NULL fall into '65+')."""
    si = with_mega_region(with_store(r.interactions(window_start(as_of, days)), r), r)
    m = (si.groupBy("gender", _age_group(F.col("age")).alias("age_group"), "emotion", "region", "mega_region")
         .agg(F.count(F.lit(1)).alias("transaction_count"),
              money_sum("total_amount").alias("total_spent"),
              F.avg("total_amount").alias("_avg"),
              F.avg(F.col("duration_seconds") / F.lit(60.0)).alias("_mins"),
              count_if(F.col("is_attendant_influenced")).alias("_infl"),
              count_if(F.col("substitution_occurred")).alias("_subs")))
    avg_v, mins = F.col("_avg"), F.col("_mins")
    return m.select("gender", "age_group", "emotion", "region", "mega_region", "transaction_count", "total_spent",
                    fixed(avg_v, 6).alias("avg_transaction_value"), fixed(mins, 6).alias("avg_duration_minutes"),
                    pct("_infl", "transaction_count").alias("influence_rate_percent"),
                    pct("_subs", "transaction_count").alias("substitution_rate_percent"),
                    F.when(avg_v >= value_cuts[0], "High Value").when(avg_v >= value_cuts[1], "Medium Value")
                    .otherwise("Low Value").alias("value_segment"),
                    F.when(mins >= minute_cuts[0], "Deliberate Shopper").when(mins >= minute_cuts[1], "Average Browser")
                    .otherwise("Quick Buyer").alias("shopping_behavior"))


def system_health(r: Retail, as_of: dt.date, anomalies: DataFrame, active_connections: int = 0) -> DataFrame:
    """One row of device, today's data quality and anomaly counts, and the
    weighted health score (40 device uptime + 30 anomalies + 30 connections);
    ``active_connections`` is a parameter (the reference reads server state).
    Division by an empty device table gives NULL."""
    stale_cut = ts_lit(midnight(as_of) - dt.timedelta(hours=24))
    st = F.col("status")
    dh = r.device_master.agg(
        F.count(F.lit(1)).alias("total_devices"),
        count_if(st == "active").alias("active_devices"),
        count_if(st == "maintenance").alias("maintenance_devices"),
        count_if(st == "offline").alias("offline_devices"),
        count_if(F.col("last_seen") < stale_cut).alias("stale_devices"))
    t0, t1 = day_bounds(as_of)
    dq = r.interactions(t0, t1).agg(
        F.count(F.lit(1)).alias("total_transactions_today"),
        count_if(F.col("total_amount") == 0).alias("zero_amount_transactions"),
        avg_money("total_amount").alias("avg_transaction_amount"))
    an = anomalies.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        count_if(F.col("status") == "active").alias("active_anomalies"),
        count_if(F.col("severity") == "high").alias("high_severity_anomalies"),
        count_if(F.col("created_at") >= ts_lit(t0)).alias("todays_anomalies"))
    conns = int(active_connections)
    high = F.col("high_severity_anomalies")
    device_part = as_double("active_devices") / F.when(F.col("total_devices") != 0, as_double("total_devices")) * 40.0
    anomaly_part = F.when(high == 0, F.lit(30.0)).otherwise(F.lit(30.0) - F.least(high * 10, F.lit(30)))
    conn_part = 30.0 if conns < 50 else 30.0 - min((conns - 50) * 2, 30)
    score = device_part + anomaly_part + F.lit(float(conn_part))
    return (with_scalars(dh, dq, an)
            .select(ts_lit(as_of).alias("health_check_time"), "total_devices", "active_devices",
                    "maintenance_devices", "offline_devices", "stale_devices",
                    pct("active_devices", "total_devices").alias("device_uptime_percent"),
                    "total_transactions_today", "zero_amount_transactions", "avg_transaction_amount",
                    "total_anomalies", "active_anomalies", "high_severity_anomalies", "todays_anomalies",
                    F.lit(conns).cast("long").alias("active_connections"),
                    fixed(score, 0).alias("overall_health_score")))


def hourly_sales_patterns(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    """Per (hour, weekday 0 = Sunday) over ``days``: count, revenue, mean,
    stores, influenced, and counts for region LIKE '%NCR%' and each mega region."""
    si = with_mega_region(with_store(r.interactions(window_start(as_of, days)), r), r)
    ts = F.col("transaction_date")
    mega = F.col("mega_region")
    return (si.groupBy(hour(ts).alias("hour_of_day"), dow(ts).alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum("total_amount").alias("total_revenue"),
                 avg_money("total_amount").alias("avg_transaction_value"),
                 count_distinct("store_id").alias("active_stores"),
                 count_if(F.col("is_attendant_influenced")).alias("influenced_transactions"),
                 count_when(F.col("region").like("%NCR%")).alias("ncr_transactions"),
                 count_when(mega == "Luzon").alias("luzon_transactions"),
                 count_when(mega == "Visayas").alias("visayas_transactions"),
                 count_when(mega == "Mindanao").alias("mindanao_transactions")))


def security_dashboard(r: Retail, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Audit rows of the last ``days`` per (date, table, action): count,
    distinct users, distinct IPs."""
    audit = r.audit_log.where(F.col("audit_ts") >= ts_lit(midnight(as_of) - dt.timedelta(days=days)))
    return (audit.groupBy(F.to_date("audit_ts").alias("audit_date"), "table_name", "action")
            .agg(F.count(F.lit(1)).alias("action_count"), count_distinct("user_id").alias("unique_users"),
                 count_distinct("ip_address").alias("unique_ips")))


def failed_access_attempts(r: Retail, as_of: dt.datetime, hours: int = 24, min_attempts: int = 5) -> DataFrame:
    """FAILED_ACCESS audit rows since ``as_of`` (midnight) minus ``hours`` per
    (ip, agent) with more than ``min_attempts`` rows: count, first, last."""
    audit = r.audit_log.where((F.col("action") == "FAILED_ACCESS")
                              & (F.col("audit_ts") >= ts_lit(midnight(as_of) - dt.timedelta(hours=hours))))
    return (audit.groupBy("ip_address", "user_agent")
            .agg(F.count(F.lit(1)).alias("attempt_count"), F.min("audit_ts").alias("first_attempt"),
                 F.max("audit_ts").alias("last_attempt"))
            .where(F.col("attempt_count") > min_attempts))


def table_volume_monitor(r: Retail, views: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the fact tables and of the given stored views."""
    frames = {"sales_interactions": r.interactions(), "transaction_items": r.transaction_items, **views}
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
