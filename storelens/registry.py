"""Registered queries: key -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and runs one operator over the
whole fixture tables at the fixture ``as_of``, with the thresholds the fixtures
need (FIXTURES.md §3) where the reference defaults would put every row in one
tier. The oracle receives the same parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens import jobs
from storelens.oracles import access_sql, dash_sql, metrics_sql, proc_sql, stream_sql, views_sql
from storelens.operators import access, anomalies, dashboards, diff, incremental, metrics, prep, procedures, views
from storelens.plans.scalars import with_scalars
from storelens.session import scratch_path
from storelens.sources import contract, sinks
from storelens.streaming import streams
from storelens.params import FIXTURE_AS_OF, FIXTURE_AUDIT_AS_OF
from storelens.sources.record_log import RecordLog
from storelens.sources.retail import Retail

AS_OF = FIXTURE_AS_OF
AUDIT_AS_OF = FIXTURE_AUDIT_AS_OF

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(key: str, oracle: str | None):
    def deco(fn: Callable[[Retail], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Times are wall-clock UTC (TIMESTAMP_NTZ); day windows and epoch
            # arithmetic assume a UTC session.
            if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Retail.for_dir(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        _REGISTRY[key] = (run, oracle)
        return fn

    return deco


# ----------------------------------------------------------------- §2.2 views
PRODUCT_TIERS = (100, 50)
RFM = dict(monetary=(800000, 400000), frequency=(3, 2))

register("daily_sales", views_sql.daily_sales(90))(lambda r: views.daily_sales(r, AS_OF, 90))
register("product_performance", views_sql.product_performance(90, PRODUCT_TIERS))(
    lambda r: views.product_performance(r, AS_OF, 90, tiers=PRODUCT_TIERS))
register("customer_segments", views_sql.customer_segments(365, **RFM))(
    lambda r: views.customer_segments(r, AS_OF, 365, **RFM))
register("regional_performance", views_sql.regional_performance(90))(
    lambda r: views.regional_performance(r, AS_OF, 90))
register("regional_performance_dedup", views_sql.regional_performance_dedup(90))(
    lambda r: views.regional_performance_dedup(r, AS_OF, 90))
register("philippine_market_analysis", views_sql.philippine_market_analysis(90))(
    lambda r: views.philippine_market_analysis(r, AS_OF, 90))
register("focus_brand_performance", views_sql.focus_brand_performance(90))(
    lambda r: views.focus_brand_performance(r, AS_OF, 90))
register("brand_competition", views_sql.brand_competition(30))(lambda r: views.brand_competition(r, AS_OF, 30))
register("category_performance", views_sql.category_performance(30))(
    lambda r: views.category_performance(r, AS_OF, 30))
register("daily_sales_summary", views_sql.daily_sales_summary(90))(
    lambda r: views.daily_sales_summary(r, AS_OF, 90))
register("executive_kpis", views_sql.executive_kpis(30))(lambda r: views.executive_kpis(r, AS_OF, 30))
register("daily_revenue", views_sql.daily_revenue())(lambda r: views.daily_revenue(r))
register("philippine_market_analysis_dedup", views_sql.philippine_market_analysis_dedup(90))(
    lambda r: views.philippine_market_analysis_dedup(r, AS_OF, 90))
register("daily_sales_summary_dedup", views_sql.daily_sales_summary_dedup(90))(
    lambda r: views.daily_sales_summary_dedup(r, AS_OF, 90))

# ------------------------------------------------------- §2.4 anomaly rules
HV = dict(k=1.5, base_days=30, scan_days=7)
SP = dict(k=2.0, days=90, min_txn=5)
SB = dict(rate=25.0, days=90, min_txn=10)

register("anomaly_high_value", dash_sql.anomaly_high_value(**HV))(
    lambda r: anomalies.anomaly_high_value(r, AS_OF, **HV))
register("anomaly_store_pattern", dash_sql.anomaly_store_pattern(**SP))(
    lambda r: anomalies.anomaly_store_pattern(r, AS_OF, **SP))
register("anomaly_substitution", dash_sql.anomaly_substitution(**SB))(
    lambda r: anomalies.anomaly_substitution(r, AS_OF, **SB))


def fixture_anomalies(r: Retail):
    """The anomalies table as one detection run with the fixture parameters
    (a lazy frame, built once per catalog and shared by the dashboards)."""
    cached = getattr(r, "_fixture_anomalies", None)
    if cached is None:
        cached = anomalies.detected_anomalies(r, AS_OF, high_value=HV, store_pattern=SP, substitution=SB)
        r._fixture_anomalies = cached
    return cached


FIRST_RUN, SECOND_RUN = datetime.datetime(2001, 8, 1), datetime.datetime(2001, 8, 1, 6)


def _detection(r: Retail) -> tuple[DataFrame, DataFrame]:
    return anomalies.detect_anomalies(r, AS_OF, existing=fixture_anomalies(r), run_ts=SECOND_RUN,
                                      high_value=HV, store_pattern=SP, substitution=SB)


register("detect_anomalies", dash_sql.detect_anomalies(HV, SP, SB, FIRST_RUN, SECOND_RUN))(lambda r: _detection(r)[0])
register("detect_anomalies_audit", dash_sql.detect_anomalies_audit(HV, SP, SB, SECOND_RUN))(lambda r: _detection(r)[1])

# ----------------------------------------------------------- §2.3 dashboards
STORE_TIERS = (2500000, 1500000, 800000)
VALUE_CUTS = (300000, 150000)

register("executive_dashboard", dash_sql.executive_dashboard(HV, SP, SB))(
    lambda r: dashboards.executive_dashboard(r, AS_OF, fixture_anomalies(r)))
register("store_performance_dashboard", dash_sql.store_performance_dashboard(30, STORE_TIERS))(
    lambda r: dashboards.store_performance_dashboard(r, AS_OF, 30, tiers=STORE_TIERS))
register("store_performance_dashboard_dedup", dash_sql.store_performance_dashboard_dedup(30, STORE_TIERS))(
    lambda r: dashboards.store_performance_dashboard_dedup(r, AS_OF, 30, tiers=STORE_TIERS))
register("executive_dashboard_dedup", dash_sql.executive_dashboard_dedup(HV, SP, SB))(
    lambda r: dashboards.executive_dashboard_dedup(r, AS_OF, fixture_anomalies(r)))
register("customer_analytics", dash_sql.customer_analytics(30, VALUE_CUTS))(
    lambda r: dashboards.customer_analytics(r, AS_OF, 30, value_cuts=VALUE_CUTS))
register("system_health", dash_sql.system_health(HV, SP, SB))(
    lambda r: dashboards.system_health(r, AS_OF, fixture_anomalies(r)))
register("hourly_sales_patterns", dash_sql.hourly_sales_patterns(30))(
    lambda r: dashboards.hourly_sales_patterns(r, AS_OF, 30))
register("security_dashboard", dash_sql.security_dashboard(7))(
    lambda r: dashboards.security_dashboard(r, AUDIT_AS_OF, 7))
register("failed_access_attempts", dash_sql.failed_access_attempts(24, 5))(
    lambda r: dashboards.failed_access_attempts(r, AUDIT_AS_OF, 24, 5))
register("table_volume_monitor", proc_sql.table_volume_monitor())(
    lambda r: dashboards.table_volume_monitor(r, {"daily_sales": views.daily_sales(r, AS_OF, 90),
                                                  "daily_sales_summary": views.daily_sales_summary(r, AS_OF, 90)}))

# ------------------------------------------------ §2.4 functions, procedures
SHARE_BRAND = "Brand#3"

register("get_market_share", proc_sql.get_market_share(SHARE_BRAND, None, 30))(
    lambda r: procedures.get_market_share(r, AS_OF, SHARE_BRAND, None, 30))
register("get_market_share_all", proc_sql.get_market_share(None, None, 30))(
    lambda r: procedures.get_market_share(r, AS_OF, None, None, 30))
register("market_share_ranked", proc_sql.market_share_ranked(SHARE_BRAND, None, 30))(
    lambda r: procedures.market_share_ranked(r, AS_OF, SHARE_BRAND, None, 30))
register("market_share_by_region", proc_sql.market_share_by_region(90))(
    lambda r: procedures.market_share_by_region(r, AS_OF, 90))
register("customer_insights", proc_sql.customer_insights(30, RFM))(
    lambda r: procedures.customer_insights(r, AS_OF, 30, RFM))
register("flag_fmcg", proc_sql.flag_fmcg())(lambda r: procedures.flag_fmcg(r))
register("flag_fmcg_audit", proc_sql.flag_fmcg_audit(FIRST_RUN))(
    lambda r: procedures.flag_fmcg_audit(procedures.flag_fmcg(r), FIRST_RUN))
PURGE_AUDIT_AS_OF = datetime.date(2024, 7, 20)  # audit rows from before 2024-01-20 are too old


def _purge(r: Retail) -> tuple[dict[str, DataFrame], DataFrame]:
    """Low anomalies resolved long ago, medium ones lately, high ones active."""
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    found = fixture_anomalies(r).select(
        "id", "type", "severity", F.when(F.col("severity") == "high", "active").otherwise("resolved").alias("status"),
        F.when(F.col("severity") == "low", day("2001-04-01")).when(F.col("severity") == "medium", day("2001-07-01"))
        .alias("resolved_at"))
    return procedures.purge_old_data(r, AS_OF, found, 12, audit_as_of=PURGE_AUDIT_AS_OF)


register("purge_old_data", proc_sql.purge_old_data(12, PURGE_AUDIT_AS_OF, hv=HV, sp=SP, sb=SB))(lambda r: _purge(r)[1])
for _table, _cols in (("sales_interactions", ["interaction_id"]), ("transaction_items", ["interaction_id", "product_id", "quantity"]),
                      ("audit_log", ["id", "audit_ts"]), ("anomalies", ["type", "severity", "status", "resolved_at"])):
    register(f"purge_kept_{_table}", proc_sql.purge_kept(_table, 12, PURGE_AUDIT_AS_OF, HV, SP, SB))(
        lambda r, _t=_table, _c=_cols: _purge(r)[0][_t].select(*_c))
register("system_alerts", proc_sql.system_alerts(HV, SP, SB))(
    lambda r: procedures.system_alerts(r, AS_OF, fixture_anomalies(r)))
register("alert_payload", proc_sql.alert_payload(HV, SP, SB))(
    lambda r: procedures.alert_payload(procedures.system_alerts(r, AS_OF, fixture_anomalies(r)), AS_OF))
register("security_alert", proc_sql.security_alert(168, 5, 10))(
    lambda r: procedures.security_alert(r, AUDIT_AS_OF, 168, 5, 10))
register("hash_sensitive", proc_sql.hash_sensitive())(
    lambda r: r.interactions().select("interaction_id",
                                      procedures.hash_sensitive("customer_id").alias("customer_hash")))


# ------------------------------------------------------ §2.5 access, audit
MANAGER, MANAGER2 = 7, 9
SI_COLS = ["interaction_id", "store_id", "customer_id", "transaction_date", "total_amount"]


def _policy(r: Retail, table: str, role: str, cols: list[str], **kw):
    as_of = kw.pop("as_of", AS_OF)
    start = access.policy_start(table, role, as_of, kw.get("hour", 12), kw.get("mode", "as_written"))
    df = r.interactions(start) if table == "sales_interactions" else r.table(table)
    return access.apply_policy(df, table, role, r=r, as_of=as_of,
                               grants=access.derived_grants(r), **kw).select(*cols)


register("policy_sales_analyst", access_sql.policy_sales_analyst(22))(
    lambda r: _policy(r, "sales_interactions", "data_analyst", SI_COLS, hour=22))
register("policy_sales_analyst_in_hours", access_sql.policy_sales_analyst(10))(
    lambda r: _policy(r, "sales_interactions", "data_analyst", SI_COLS, hour=10))
register("policy_sales_analyst_restrictive", access_sql.policy_sales_analyst(10, "restrictive"))(
    lambda r: _policy(r, "sales_interactions", "data_analyst", SI_COLS, hour=10, mode="restrictive"))
register("policy_sales_manager", access_sql.policy_sales_manager(MANAGER, 22))(
    lambda r: _policy(r, "sales_interactions", "store_manager", SI_COLS, hour=22, user_id=MANAGER))
register("policy_sales_manager_strict", access_sql.policy_sales_manager(MANAGER, 10, "strict"))(
    lambda r: _policy(r, "sales_interactions", "store_manager", SI_COLS, hour=10, user_id=MANAGER, mode="strict"))
register("policy_items_analyst", access_sql.policy_items_analyst())(
    lambda r: _policy(r, "transaction_items", "data_analyst", ["interaction_id", "product_id", "quantity"]))
register("policy_stores_manager", access_sql.policy_stores_manager(MANAGER2))(
    lambda r: _policy(r, "stores", "store_manager", ["id", "name", "region", "store_type"], user_id=MANAGER2))
register("policy_devices_manager", access_sql.policy_devices_manager(MANAGER))(
    lambda r: _policy(r, "device_master", "store_manager", ["device_id", "store_id", "status", "last_seen"],
                      user_id=MANAGER))
register("policy_audit_own", access_sql.policy_audit_own(MANAGER))(
    lambda r: _policy(r, "audit_log", "dashboard_user", ["id", "user_id", "action", "audit_ts"], user_id=MANAGER,
                      as_of=AUDIT_AS_OF))
register("policy_audit_viewer", access_sql.policy_audit_viewer())(
    lambda r: _policy(r, "audit_log", "audit_viewer", ["id", "user_id", "action", "audit_ts"], as_of=AUDIT_AS_OF))
register("policy_brands_denied", access_sql.policy_denied("id, name, category", "brands"))(
    lambda r: _policy(r, "brands", "data_analyst", ["id", "name", "category"]))
register("expire_access", access_sql.expire_access(datetime.datetime.combine(AS_OF, datetime.time())))(
    lambda r: access.expire_access(access.derived_grants(r), datetime.datetime.combine(AS_OF, datetime.time()))
    .select("id", "user_id", "store_id", "access_level", "expires_at", "is_active"))
GRANT_NOW = datetime.datetime(2001, 8, 1)
register("grant_access", access_sql.grant_access(0, MANAGER, 3, "write", GRANT_NOW))(
    lambda r: access.grant_access(access.derived_grants(r), granting_user=0, user_id=MANAGER, store_id=3,
                                  access_level="write", now=GRANT_NOW)[0])
# user 1 holds an active admin grant on store 18 in the sf0.01 tables (device 7)
register("grant_access_by_store_admin", access_sql.grant_access(1, 30, 18, "read", GRANT_NOW))(
    lambda r: access.grant_access(access.derived_grants(r), granting_user=1, user_id=30, store_id=18,
                                  access_level="read", now=GRANT_NOW)[0])
register("revoke_access", access_sql.revoke_access(0, MANAGER, 3, caller_is_db_admin=True))(
    lambda r: access.revoke_access(access.derived_grants(r), revoking_user=0, user_id=MANAGER, store_id=3,
                                   now=GRANT_NOW, caller_is_db_admin=True)[0])


def modified_products(r: Retail) -> DataFrame:
    """A later products snapshot derived from the current one: renamed to
    NULL (id % 40 = 7), re-categorised (id % 25 = 0), re-priced (id % 10 = 0),
    deleted (id % 50 = 1) and inserted copies (id % 100 = 3, id + 10^7)."""
    p = r.products
    i = F.col("id")
    changed = p.where(i % 50 != 1).select(
        "id", F.when(i % 40 == 7, F.lit(None).cast("string")).otherwise(F.col("name")).alias("name"),
        "brand_id", F.when(i % 25 == 0, F.upper("category")).otherwise(F.col("category")).alias("category"),
        "is_fmcg",
        F.when(i % 10 == 0, F.col("unit_price") + 1).otherwise(F.col("unit_price")).cast("decimal(10,2)")
        .alias("unit_price"))
    inserted = p.where(i % 100 == 3).withColumn("id", i + 10_000_000)
    return changed.unionByName(inserted)


register("audit_changes", access_sql.audit_changes())(
    lambda r: access.audit_changes(r.products, modified_products(r), "id", "products"))
# the same changes, of which only the key ranges that differ are joined
register("audit_changes_by_ranges", access_sql.audit_changes())(
    lambda r: access.audit_changes(*diff.differing(r.products, modified_products(r), "id"), "id", "products"))
register("product_update_guard", access_sql.product_update_guard())(
    lambda r: access.product_update_guard(r.products, modified_products(r)))


# ------------------------------------------------- §2.6 spec / UI metrics
KPI_FILTERS = dict(date_from=datetime.date(2001, 5, 1), date_to=datetime.date(2001, 7, 31),
                   regions=("ASIA", "EUROPE", "AMERICA"), categories=None,
                   brands=tuple(f"Brand#{i}" for i in range(1, 9)))
KPI_FILTERS_CAT = dict(date_from=datetime.date(2001, 1, 1), date_to=datetime.date(2001, 8, 1), regions=None,
                       categories=("STANDARD POLISHED TIN", "PROMO BRUSHED COPPER", "LARGE ANODIZED STEEL"),
                       brands=None)
SLICE_PARAMS = dict(store_tiers=STORE_TIERS, value_cuts=VALUE_CUTS, hv=HV, sp=SP, sb=SB, audit_as_of=AUDIT_AS_OF.date())
DQ_NOW = datetime.datetime(2001, 8, 1, 23, 59, 59)

register("kpi_cards", metrics_sql.kpi_cards(**KPI_FILTERS))(lambda r: metrics.kpi_cards(r, **KPI_FILTERS))
register("kpi_cards_by_category", metrics_sql.kpi_cards(**KPI_FILTERS_CAT))(
    lambda r: metrics.kpi_cards(r, **KPI_FILTERS_CAT))
register("revenue_trend", metrics_sql.revenue_trend(30))(lambda r: metrics.revenue_trend(r, AS_OF, 30))
register("category_top10", metrics_sql.category_top(10))(lambda r: metrics.category_top(r, 10))
register("brand_top8", metrics_sql.brand_top(8))(lambda r: metrics.brand_top(r, 8))
register("brand_top10", metrics_sql.brand_top10())(
    lambda r: metrics.top_rows(views.focus_brand_performance(r, AS_OF, 90),
                               [F.col("total_revenue").desc(), "brand_name", "category"], 10))
register("executive_one", dash_sql.executive_dashboard(HV, SP, SB) + " LIMIT 1")(
    lambda r: dashboards.executive_dashboard(r, AS_OF, fixture_anomalies(r)).limit(1))
register("region_list", metrics_sql.region_list())(
    lambda r: views.philippine_market_analysis(r, AS_OF, 90).orderBy(F.col("total_revenue").desc()))
register("hour_distribution", metrics_sql.hour_distribution())(
    lambda r: metrics.hour_distribution(dashboards.hourly_sales_patterns(r, AS_OF, 30)))
register("dow_distribution", metrics_sql.dow_distribution())(
    lambda r: metrics.dow_distribution(dashboards.hourly_sales_patterns(r, AS_OF, 30)))
register("region_revenue", metrics_sql.region_revenue())(
    lambda r: views.regional_performance(r, AS_OF, 90).select("region", "total_revenue", "revenue_rank"))
register("top_products", metrics_sql.top_products(PRODUCT_TIERS, 10))(
    lambda r: views.top_products(r, AS_OF, 90, 10))
register("age_distribution", metrics_sql.age_distribution(30))(lambda r: metrics.age_distribution(r, AS_OF, 30))
register("gender_distribution", metrics_sql.gender_distribution(30))(
    lambda r: metrics.gender_distribution(r, AS_OF, 30))
register("segment_table", metrics_sql.segment_table(RFM))(
    lambda r: metrics.share_table(views.customer_segments(r, AS_OF, 365, **RFM), "customer_segment"))
register("period_over_period", metrics_sql.period_over_period(30))(
    lambda r: metrics.period_over_period(r, AS_OF, 30))
register("period_over_period_quarter", metrics_sql.period_over_period(91))(
    lambda r: metrics.period_over_period(r, AS_OF, 91))
register("category_mix_trend", metrics_sql.category_mix_trend(90))(
    lambda r: metrics.category_mix_trend(r, AS_OF, 90))
register("brand_mix", metrics_sql.brand_mix(30))(lambda r: metrics.brand_mix(r, AS_OF, 30))
register("bundle_rate", metrics_sql.bundle_rate(90))(lambda r: metrics.bundle_rate(r, AS_OF, 90))
register("repeat_rate_30d", metrics_sql.repeat_rate(365, 30))(lambda r: metrics.repeat_rate(r, AS_OF, 365, 30))
register("regional_affinity", metrics_sql.regional_affinity(90))(lambda r: metrics.regional_affinity(r, AS_OF, 90))
register("cohort_retention", metrics_sql.cohort_retention())(lambda r: metrics.cohort_retention(r))
register("focus_brand_by_region", metrics_sql.focus_brand_by_region(90, 20))(
    lambda r: metrics.focus_brand_by_region(r, AS_OF, 90, 20))
register("demographic_spend", metrics_sql.demographic_spend(VALUE_CUTS))(
    lambda r: metrics.demographic_spend(dashboards.customer_analytics(r, AS_OF, 30, value_cuts=VALUE_CUTS)))
register("category_competition", metrics_sql.category_competition())(
    lambda r: metrics.category_competition(views.brand_competition(r, AS_OF, 30)))
register("unit_convert", metrics_sql.unit_convert())(
    lambda r: metrics.unit_convert(
        r.transaction_items.join(r.raw("part").select("p_partkey", "p_size"),
                                 F.col("product_id") == F.col("p_partkey"))
        .withColumn("unit", F.when(F.col("p_size") % 2 == 0, "pack").otherwise("pcs"))
        .select("interaction_id", "product_id", "quantity", "unit")))
register("term_localize", metrics_sql.term_localize())(
    lambda r: r.raw("part").select(F.col("p_partkey").alias("id"), metrics.term_localize("p_name").alias("name")))


def _slices(r: Retail) -> dict[str, DataFrame]:
    return {
        "slice_top_stores": dashboards.store_performance_dashboard(r, AS_OF, 30, tiers=STORE_TIERS)
        .where(F.col("performance_tier") == "Top Performer"),
        "slice_client_brands": views.brand_competition(r, AS_OF, 30).where(F.col("brand_type") == "Client")
        .orderBy(F.col("revenue").desc()),
        "slice_luzon_customers": dashboards.customer_analytics(r, AS_OF, 30, value_cuts=VALUE_CUTS)
        .where(F.col("mega_region") == "Luzon").orderBy(F.col("total_spent").desc()),
        "slice_market_by_share": views.philippine_market_analysis(r, AS_OF, 90)
        .orderBy(F.col("client_market_share_percent").desc()),
        "slice_active_anomalies": fixture_anomalies(r).where(F.col("status") == "active")
        .select("type", "severity", "status").orderBy(F.col("severity").desc()),
        "slice_monday_hours": dashboards.hourly_sales_patterns(r, AS_OF, 30).where(F.col("day_of_week") == 1),
        "slice_business_hours": dashboards.hourly_sales_patterns(r, AS_OF, 30)
        .where(F.col("hour_of_day").between(9, 17)),
        "slice_recent_security": dashboards.security_dashboard(r, AUDIT_AS_OF, 7)
        .where(F.col("audit_date") >= F.lit(AUDIT_AS_OF.date() - datetime.timedelta(days=7))),
    }


for _key in ("slice_top_stores", "slice_client_brands", "slice_luzon_customers", "slice_market_by_share",
             "slice_active_anomalies", "slice_monday_hours", "slice_business_hours", "slice_recent_security"):
    register(_key, metrics_sql.slice_sql(_key, SLICE_PARAMS))(lambda r, _k=_key: _slices(r)[_k])

# --------------------------------------------------- validation / quality
_SCORED_VIEWS_SQL = {"daily_sales": views_sql.daily_sales(90),
                     "focus_brand_performance": views_sql.focus_brand_performance(90),
                     "philippine_market_analysis": views_sql.philippine_market_analysis(90)}

register("dq_score", metrics_sql.dq_score(DQ_NOW))(lambda r: metrics.dq_score(r, DQ_NOW))
register("market_checks", metrics_sql.market_checks())(lambda r: metrics.market_checks(r))
register("deployment_score", metrics_sql.deployment_score(_SCORED_VIEWS_SQL))(
    lambda r: metrics.deployment_score(r, {"daily_sales": views.daily_sales(r, AS_OF, 90),
                                           "focus_brand_performance": views.focus_brand_performance(r, AS_OF, 90),
                                           "philippine_market_analysis":
                                               views.philippine_market_analysis(r, AS_OF, 90)}))
PRESENT_TABLES = ("sales_interactions", "transaction_items", "products", "brands", "stores", "device_master",
                  "ph_regions", "audit_log")
MISSING_TABLES = ("anomalies", "user_store_access", "request_methods", "session_matches")
register("table_presence", metrics_sql.table_presence(PRESENT_TABLES, MISSING_TABLES))(
    lambda r: metrics.table_presence(r, PRESENT_TABLES + MISSING_TABLES))
register("count_reconcile", metrics_sql.count_reconcile())(
    lambda r: metrics.count_reconcile(r.interactions(), r.raw("orders")))

# ------------------------------------------------------- data preparation
register("allocate_by_weight", metrics_sql.allocate_by_weight(100))(lambda r: prep.allocate_by_weight(r, 100))
register("backfill_totals", metrics_sql.backfill_totals())(lambda r: prep.backfill_totals(r))
register("session_keys", metrics_sql.session_keys())(lambda r: prep.session_keys(r))
register("dim_lookup", metrics_sql.dim_lookup())(
    lambda r: prep.dim_lookup(r.product_dim.select("id", "name", "brand_name"), r.brands, "brand_name"))


# ------------------------------------------------------ §2.1 sources, sinks
def _scratch(r: Retail, name: str) -> str:
    return scratch_path(r.spark, name)


register("load_retail", stream_sql.load_retail())(lambda r: r.interactions())


def damaged_feed(r: Retail, table: str) -> DataFrame:
    """A table as a raw feed in which some values are wrong."""
    feed = contract.raw_feed(r.table(table))
    own = [(column, when, value) for t, _, column, when, value, _ in stream_sql.DAMAGE if t == table]
    out = {c: F.col(c) for c in feed.columns}
    for column, when, value in own:
        out[column] = F.when(F.expr(when), F.expr(value)).otherwise(out[column])
    return feed.select(*[out[c].cast("string").alias(c) for c in feed.columns])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _load_tables(r: Retail) -> DataFrame:
    def one(table: str) -> DataFrame:
        key, measure = stream_sql.MEASURES[table]
        loaded, rejected = contract.load(damaged_feed(r, table), table)
        good = loaded.agg(F.count(F.lit(1)).alias("loaded"), F.sum(key).cast("decimal(38,4)").alias("key_sum"),
                          F.sum(measure).cast("decimal(38,4)").alias("measure_sum"))
        bad = rejected.agg(F.count(F.lit(1)).alias("rejected"))
        return with_scalars(good, bad).select(F.lit(table).alias("table_name"), "loaded", "rejected", "key_sum", "measure_sum")

    return _union([one(t) for t in contract.CONTRACTS])


register("load_retail_tables", stream_sql.load_retail_tables())(_load_tables)
register("load_retail_rejected", stream_sql.load_retail_rejected({t: [c.name for c in x] for t, x in contract.CONTRACTS.items()}))(
    lambda r: _union([contract.load(damaged_feed(r, t), t)[1] for t in contract.CONTRACTS]).select(
        "table_name", "row_key", F.concat_ws("; ", "reasons").alias("reasons")))
register("table_select", stream_sql.table_select())(
    lambda r: r.stores.where(F.col("region") == "ASIA").orderBy("name"))
register("table_select_single", stream_sql.table_select_single())(
    lambda r: r.products.where(F.col("id") == 5).limit(1))
register("export_transactions", stream_sql.export_transactions())(
    lambda r: sinks.export_transactions(
        r.interactions().select("interaction_id", "store_id", "customer_id", "transaction_date", "total_amount"),
        _scratch(r, "exports-transactions")))
register("export_json", stream_sql.export_json())(
    lambda r: sinks.export_json(views.brand_competition(r, AS_OF, 30), _scratch(r, "lake"), "brand_competition",
                                AS_OF))
register("export_csv", stream_sql.export_csv())(lambda r: sinks.export_csv(r.stores, _scratch(r, "csv")))


def _raw_zone(r: Retail) -> DataFrame:
    df, _count = sinks.raw_zone_append(r.interactions().select("interaction_id", "store_id", "total_amount"),
                                       _scratch(r, "raw"), "transactions", datetime.datetime(2001, 8, 1))
    return df


def _inventory(r: Retail) -> DataFrame:
    """The folders that an export made (file names differ from run to run)."""
    base = _scratch(r, "inventory")
    sinks.export_transactions(r.interactions().select("interaction_id", "transaction_date"), base)
    folder = F.regexp_extract("name", "(sale_date=[0-9-]+)/part-", 1)
    return sinks.file_inventory(r.spark, base).where("content_length > 0").select(folder.alias("folder")).where(
        "folder <> ''").distinct()


LAKE_PARTS, LAKE_AGE = 3, 40


def _lifecycle(r: Retail) -> DataFrame:
    """A lake of baskets written in three appends, its files' ages and tiers, and the same lake with its small files joined.

    The inventory's clock is set ``LAKE_AGE`` days after the files were written."""
    base, out = _scratch(r, "lake-files"), _scratch(r, "lake-joined")
    baskets = r.interactions().select("interaction_id", "total_amount", F.date_format("transaction_date", "yyyy-MM").alias("sale_month"))
    for k in range(LAKE_PARTS):
        (baskets.where(F.col("interaction_id") % LAKE_PARTS == k).hint("rebalance", "sale_month")
         .write.mode("append").partitionBy("sale_month").parquet(base))
    inventory = sinks.file_inventory(r.spark, base).where("content_length > 0").where(F.col("name").endswith(".parquet"))
    written = inventory.agg(F.max("last_modified")).first()[0]
    plan = sinks.compaction_plan(sinks.lake_lifecycle_plan(inventory, written + datetime.timedelta(days=LAKE_AGE)), base)
    month = F.regexp_extract("folder", "sale_month=(.*)", 1).alias("sale_month")
    files = plan.groupBy(month, F.col("age_days"), F.col("action")).agg(F.count(F.lit(1)).alias("files"), F.count("bin").alias("to_join"))
    joined = sinks.compact_lake(r.spark, base, out, plan)
    kept = joined.groupBy(F.date_format("sale_month", "yyyy-MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("rows_kept"), F.count_distinct(F.col("_metadata.file_name")).alias("files_left"))
    return files.join(kept, F.col("sale_month") == F.col("_month")).drop("_month")


def _snapshot(r: Retail) -> DataFrame:
    base = _scratch(r, "snapshots")
    build = lambda: views.daily_sales(r, AS_OF, 90)
    sinks.snapshot_refresh(r.spark, base, "daily_sales", build(), datetime.datetime(2001, 8, 1, 1))
    return sinks.snapshot_if_stale(r.spark, base, "daily_sales", build, 600, datetime.datetime(2001, 8, 1, 1, 5))


register("raw_zone_append", stream_sql.raw_zone_append("2001-08-01T00:00:00"))(_raw_zone)
register("file_inventory", stream_sql.file_inventory())(_inventory)
register("lake_lifecycle_plan", stream_sql.lake_files(LAKE_PARTS, LAKE_AGE))(_lifecycle)
register("snapshot_refresh", stream_sql.row_counts({"brand_competition": views_sql.brand_competition(30)}))(
    lambda r: sinks.snapshot_refresh(r.spark, _scratch(r, "snapshots"), "brand_competition",
                                     views.brand_competition(r, AS_OF, 30)).select("name", "row_count"))
# the stored daily_sales version read back must equal the view itself
register("snapshot_if_stale", views_sql.daily_sales(90))(_snapshot)

CHANGED_DAY = datetime.date(2001, 7, 15)


def _maintained(r: Retail) -> str:
    """Day aggregates of a lake of baskets, refreshed after one of its days has lost a third of its baskets (made once)."""
    if done := getattr(r, "_day_aggregates", None):
        return done
    lake, base = _scratch(r, "basket-lake"), _scratch(r, "day-aggregates")
    columns = ["interaction_id", "store_id", "customer_id", "transaction_date", "total_amount", "is_attendant_influenced",
               "substitution_occurred"]
    baskets = r.interactions().select(*columns)
    sinks.export_transactions(baskets, lake)
    incremental.refresh(r.spark, lake, base)
    day = F.to_date("transaction_date") == F.lit(CHANGED_DAY)
    baskets.where(day & (F.col("interaction_id") % 3 != 0)).write.mode("overwrite").parquet(f"{lake}/sale_date={CHANGED_DAY.isoformat()}")
    incremental.refresh(r.spark, lake, base)
    r._day_aggregates = base
    return base


register("incremental_daily_sales", stream_sql.incremental_daily_sales(CHANGED_DAY))(
    lambda r: incremental.daily_sales(r.spark, _maintained(r), r.stores, AS_OF, 90))
register("region_customer_windows", stream_sql.region_windows(CHANGED_DAY))(
    lambda r: incremental.region_windows(r.spark, _maintained(r), r.stores, AS_OF))

# ------------------------------------------------------------ §2.7 streams
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
STREAM_NOW = datetime.datetime(2024, 1, 31)


#: Several micro-batches, whose files may come in any order.
STREAM_FILES = 4


def _replayed(r: Retail, df: DataFrame, name: str) -> DataFrame:
    """A table replayed as a file stream, one file at a time."""
    src = _scratch(r, name)
    df.repartition(STREAM_FILES).write.parquet(src)
    return r.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


def _delay(r: Retail) -> str:
    """As long as the table's own time span: files may come in any order, and no row is late."""
    span = r.raw("events").agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    return f"{span + 1} days"


def _run_rule(r: Retail, agg: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The resolved sink of a stream over all files; rows that the watermark dropped are an error."""
    sink, ck = _scratch(r, f"{name}-sink"), _scratch(r, f"{name}-ckpt")
    told = streams.run_update_stream(agg, sink, ck, f"{name}_{abs(hash(sink)) % 10**8}")
    if told["rows_dropped_by_watermark"]:
        raise RuntimeError(f"{name}: {told['rows_dropped_by_watermark']} rows came later than the watermark's delay")
    return streams.latest_rows(r.spark, sink, keys)


def _events(r: Retail) -> DataFrame:
    return _replayed(r, r.raw("events"), "events-src")


def _live_kpis(r: Retail) -> DataFrame:
    sink = _scratch(r, "live-sink")
    streams.live_kpis_job(_replayed(r, r.interactions(), "live-src"), _scratch(r, "live-lake"), sink,
                          _scratch(r, "live-ckpt"), f"live_{abs(hash(sink)) % 10**8}")
    return streams.latest_rows(r.spark, sink, ["day"])


THRESHOLD = 40.0
register("live_kpis", stream_sql.live_kpis())(_live_kpis)
register("metric_threshold_alert", stream_sql.metric_threshold_alert(THRESHOLD))(
    lambda r: streams.firing(_run_rule(r, streams.metric_threshold_windows(_events(r), THRESHOLD, _delay(r)),
                                       ["window_start", "metric"], "threshold")))
register("error_burst_alert", stream_sql.error_burst_alert(1))(
    lambda r: streams.error_burst_alert(_run_rule(r, streams.error_bins(_events(r), _delay(r), 1), ["bin_start"],
                                                  "errbins")))
register("rate_limit_violations", stream_sql.rate_limit_violations(1))(
    lambda r: _run_rule(r, streams.rate_limit_violations(_events(r), _delay(r), 1), ["window_start", "client"],
                        "ratelimit"))
register("error_rate", stream_sql.error_rate())(
    lambda r: _run_rule(r, streams.error_rate(_events(r), watermark=_delay(r)), ["window_start"], "errorrate"))
register("latency_p95", stream_sql.latency_p95())(lambda r: streams.latency_p95(r.raw("events")))
register("freshness", stream_sql.freshness(STREAM_NOW))(
    lambda r: streams.freshness(_run_rule(r, streams.newest_event(_events(r)), ["one"], "newest"), STREAM_NOW))
register("metric_heatmap", stream_sql.metric_heatmap())(
    lambda r: _run_rule(r, streams.metric_heatmap(_events(r), watermark=_delay(r)), ["bucket_start", "component"], "heatmap"))


def _latency_stream(r: Retail) -> DataFrame:
    """Sketches of a stream, merged, held against the ranks that their answers have among all values."""
    sink = _scratch(r, "sketch-sink")
    streams.latency_sketch_job(_events(r), sink, _scratch(r, "sketch-ckpt"), f"sketch_{abs(hash(sink)) % 10**8}")
    found = streams.latency_from_sketches(r.spark.read.parquet(sink))
    start = F.window(F.col("ts").cast("timestamp"), "1 day").getField("start").cast("timestamp_ntz")
    values = r.raw("events").where("value is not null").select(start.alias("_start"), F.round("value", 6).alias("_value"))
    ranks = (found.join(values, F.col("window_start") == F.col("_start")).groupBy("window_start", "samples")
             .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_value") < F.col("p95_value"), 1)).alias("below"),
                  F.count(F.when(F.col("_value") <= F.col("p95_value"), 1)).alias("upto")))
    rank, slack = F.ceil(F.col("n") * 0.95), F.col("n") * 0.02
    return ranks.select("window_start", "samples", ((F.col("below") < rank + slack) & (F.col("upto") >= rank - slack)).alias("within_two_percent"))


register("latency_p95_stream", stream_sql.latency_p95_stream())(_latency_stream)
register("cdc_diff", stream_sql.cdc_diff(access_sql.MODIFIED_PRODUCTS_CTE))(
    lambda r: streams.cdc_diff(r.products, modified_products(r), "id"))
register("cdc_diff_by_ranges", stream_sql.cdc_diff(access_sql.MODIFIED_PRODUCTS_CTE))(
    lambda r: streams.cdc_diff(*diff.differing(r.products, modified_products(r), "id"), "id"))


def _stream_ingest(r: Retail) -> DataFrame:
    src, sink, ck = _scratch(r, "ingest-src"), _scratch(r, "ingest-sink"), _scratch(r, "ingest-ckpt")
    r.raw("events").write.options(**sinks.JSON_OPTIONS).json(src)
    stream = r.spark.readStream.schema(EVENT_SCHEMA).options(**sinks.JSON_OPTIONS).json(src)
    streams.stream_ingest_json(stream, sink, ck)
    return sinks.read_lake_json(r.spark, sink, EVENT_SCHEMA)


def modified_customers(r: Retail) -> tuple[DataFrame, DataFrame]:
    """Customer records, and later ones: every 40th in another segment, copies of every 100th new."""
    now = r.raw("customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name"),
                                   F.col("c_mktsegment").alias("segment"), F.lit("load").alias("updated_by"))
    moved = F.col("id") % 40 == 7
    later = now.select("id", "name", F.when(moved, F.lower("segment")).otherwise(F.col("segment")).alias("segment"),
                       F.when(moved, "clerk").otherwise(F.col("updated_by")).alias("updated_by"))
    return now, later.unionByName(now.where(F.col("id") % 100 == 3).withColumn("id", F.col("id") + 10_000_000))


CUSTOMERS_CTES = """customers AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_mktsegment AS segment, 'load' AS updated_by FROM customer),
customers_new AS (
  SELECT id, name, CASE WHEN id % 40 = 7 THEN lower(segment) ELSE segment END AS segment,
    CASE WHEN id % 40 = 7 THEN 'clerk' ELSE updated_by END AS updated_by FROM customers
  UNION ALL SELECT id + 10000000, name, segment, updated_by FROM customers WHERE id % 100 = 3)"""


def _cdc_route(r: Retail) -> DataFrame:
    """All routes read back from the lake."""
    src, base, ck = _scratch(r, "cdc-src"), _scratch(r, "cdc-out"), _scratch(r, "cdc-ckpt")
    changes = access.audit_changes(r.products, modified_products(r), "id", "products").unionByName(
        access.audit_changes(*modified_customers(r), "id", "customers"))
    (changes.select(F.col("table_name").alias("table"), F.col("action").alias("eventType"),
                    F.col("new_data").alias("new"), F.col("old_data").alias("old"),
                    F.lit(datetime.datetime(2001, 8, 1)).alias("commit_ts"))
     .repartition(STREAM_FILES).write.options(**sinks.JSON_OPTIONS).json(src))
    streams.cdc_route(r.spark, src, base, ck, max_files=1)
    read = lambda route, schema: r.spark.read.schema(schema).json(f"{base}/{route}")
    text = lambda c: F.col(c) if c else F.lit(None).cast("string")

    def rows(route: str, schema: str, table: str | None, kind: str, record: str | None, user: str | None, payload: str) -> DataFrame:
        return read(route, schema).select(
            F.lit(route).alias("route"), F.col("table") if table is None else F.lit(table).alias("table"),
            (F.col(kind) if kind in ("eventType", "change_type") else F.lit(kind)).alias("change_type"),
            text(record).alias("record_id"), text(user).alias("user_id"), F.col(payload).alias("payload"))

    return (rows("raw-data", "table string, eventType string, new string", None, "eventType", None, None, "new")
            .unionByName(rows("customer-changes", "customerId string, change_type string, record string", "customers",
                              "change_type", "customerId", None, "record"))
            .unionByName(rows("audit-trail", "table string, record_id string, user_id string, changes string", None,
                              "UPDATE", "record_id", "user_id", "changes")))


register("stream_ingest_json", stream_sql.stream_ingest_json())(_stream_ingest)


def _ingest_records(r: Retail) -> DataFrame:
    """A record log that grows between two runs of one query, some records broken: all of them, stored or quarantined."""
    log, sink, bad, ck = (_scratch(r, f"log-{x}") for x in ("records", "sink", "quarantine", "ckpt"))
    kind = F.col("event_id") % 50
    whole = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props"), {**sinks.JSON_OPTIONS, "ignoreNullFields": "false"})
    timeless = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    text = (F.when(kind == 7, F.concat(F.lit("#"), F.col("event_id").cast("string"), F.lit(" {broken")))
            .when(kind == 9, timeless).when(kind == 11, F.concat(F.lit('{"event_id":"#'), F.col("event_id").cast("string"), F.lit('"}')))
            .otherwise(whole))
    r.spark.dataSource.register(RecordLog)
    for half in (0, 1):
        (r.raw("events").where(F.col("event_id") % 2 == half).select(text.alias("value")).write.mode("append")
         .option("compression", "none").text(log))
        lines = r.spark.readStream.format("record_log").option("suffix", ".txt").option("chunkBytes", 200_000).load(log)
        streams.ingest_records(lines, EVENT_SCHEMA, sink, bad, ck, required=("event_id", "ts"), name=f"log_{half}_{abs(hash(sink)) % 10**8}")
    good = sinks.read_lake_json(r.spark, sink, EVENT_SCHEMA).select(
        "event_id", F.lit("stored").alias("fate"), F.lit(None).cast("string").alias("reason"), "ts", "event_type", "value")
    number = F.regexp_extract("value", '(?:^#|"event_id":"?#?)([0-9]+)', 1).cast("long").alias("event_id")
    none = r.spark.read.parquet(bad).select(number, F.lit("quarantined").alias("fate"), "reason", F.lit(None).cast("timestamp_ntz").alias("ts"),
                                            F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"))
    return good.unionByName(none)


register("stream_ingest_records", stream_sql.stream_ingest_records())(_ingest_records)

# ------------------------------------------------------------- refresh job
REFRESH_PARAMS = {"product_performance": {"tiers": PRODUCT_TIERS}, "store_performance_dashboard": {"tiers": STORE_TIERS},
                  "customer_analytics": {"value_cuts": VALUE_CUTS},
                  "anomalies": {"high_value": HV, "store_pattern": SP, "substitution": SB}}

STORED_VIEWS_SQL = {
    "daily_sales": views_sql.daily_sales(90), "product_performance": views_sql.product_performance(90, PRODUCT_TIERS),
    "regional_performance": views_sql.regional_performance(90),
    "philippine_market_analysis": views_sql.philippine_market_analysis(90),
    "focus_brand_performance_view": views_sql.focus_brand_performance(90),
    "brand_competition_dashboard": views_sql.brand_competition(30),
    "category_performance_analytics": views_sql.category_performance(30),
    "mv_daily_sales_summary": views_sql.daily_sales_summary(90), "mv_executive_kpis": views_sql.executive_kpis(30),
    "store_performance_dashboard": dash_sql.store_performance_dashboard(30, STORE_TIERS),
    "customer_analytics_dashboard": dash_sql.customer_analytics(30, VALUE_CUTS),
    "hourly_sales_patterns": dash_sql.hourly_sales_patterns(30),
    "executive_dashboard": dash_sql.executive_dashboard(HV, SP, SB),
    "system_health_dashboard": dash_sql.system_health(HV, SP, SB),
}
register("refresh_analytics", stream_sql.row_counts(STORED_VIEWS_SQL))(
    lambda r: jobs.refresh_analytics(r.spark, r, _scratch(r, "refresh"), AS_OF, REFRESH_PARAMS).select("name", "row_count"))
register("brand_competition_shared_lines", views_sql.brand_competition(30))(
    lambda r: views.brand_competition(jobs.with_shared_lines(r, datetime.datetime(2001, 5, 3)), AS_OF, 30))
register("executive_kpis_shared_lines", views_sql.executive_kpis(30))(
    lambda r: views.executive_kpis(jobs.with_shared_lines(r, datetime.datetime(2001, 5, 3)), AS_OF, 30))
register("cdc_route", stream_sql.cdc_route(access_sql.MODIFIED_PRODUCTS_CTE, CUSTOMERS_CTES))(_cdc_route)


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
