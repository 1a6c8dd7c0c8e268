"""DuckDB oracles for anomaly rules and live dashboards, derived anew from their semantics.

Column names, labels and thresholds are fixed values of the views.
"""

from __future__ import annotations

import datetime as dt

from storelens.oracles.common import (
    AS_OF, FOCUS, big, date, fanned_baskets, fx, level, line_rev, money, msum, pct, ratio, since, ts, weighted_mean,
    with_adapter,
)
from storelens.params import FIXTURE_AUDIT_AS_OF

AUDIT_AS_OF = FIXTURE_AUDIT_AS_OF


# ------------------------------------------------------------ anomaly rules
def high_value_body(k: float = 3.0, base_days: int = 30, scan_days: int = 7) -> str:
    return f"""
SELECT 'SUSPICIOUS_TRANSACTION' AS anomaly_type, interaction_id, store_id, total_amount AS amount,
  {fx('st.th', 2)} AS threshold, transaction_date,
  CASE WHEN CAST(total_amount AS DOUBLE) > st.th * 2 THEN 'high' ELSE 'medium' END AS severity
FROM sales_interactions
CROSS JOIN (SELECT AVG(total_amount) + {float(k)!r} * STDDEV(total_amount) AS th
            FROM sales_interactions WHERE transaction_date >= {since(base_days)}) st
WHERE transaction_date >= {since(scan_days)} AND CAST(total_amount AS DOUBLE) > st.th"""


def store_pattern_body(k: float = 2.0, days: int = 7, min_txn: int = 5) -> str:
    """Stores against the mean and spread of all qualifying stores' means (windows over the stores)."""
    return f"""
SELECT 'UNUSUAL_PATTERN' AS anomaly_type, store_id, {fx('mean', 6)} AS store_avg_amount,
  {fx('center', 6)} AS overall_avg_amount, {ratio('ABS(mean - center)', 'spread', 1.0, 4)} AS deviation_factor,
  'medium' AS severity
FROM (SELECT store_id, mean, AVG(mean) OVER () AS center, STDDEV(mean) OVER () AS spread
      FROM (SELECT store_id, AVG(total_amount) AS mean FROM sales_interactions WHERE transaction_date >= {since(days)}
            GROUP BY store_id HAVING COUNT(*) >= {min_txn}))
WHERE ABS(mean - center) > {float(k)!r} * spread"""


def substitution_body(rate: float = 25.0, days: int = 7, min_txn: int = 10) -> str:
    return f"""
SELECT 'HIGH_SUBSTITUTION_RATE' AS anomaly_type, store_id, {fx('100.0 * hits / n', 4)} AS substitution_rate,
  n AS transaction_count, 'low' AS severity
FROM (SELECT store_id, COUNT(*) AS n, CAST(COUNT(*) FILTER (substitution_occurred) AS DOUBLE) AS hits
      FROM sales_interactions WHERE transaction_date >= {since(days)} GROUP BY store_id)
WHERE n >= {min_txn} AND 100.0 * hits / n > {float(rate)!r}"""


def anomaly_high_value(**kw) -> str:
    return with_adapter() + high_value_body(**kw)


def anomaly_store_pattern(**kw) -> str:
    return with_adapter() + store_pattern_body(**kw)


def anomaly_substitution(**kw) -> str:
    return with_adapter() + substitution_body(**kw)


def anomalies_cte(hv: dict, sp: dict, sb: dict) -> str:
    created = ts(AS_OF)
    return f"""anomalies AS (
  SELECT anomaly_type AS type, severity, 'active' AS status, {created} AS created_at FROM ({high_value_body(**hv)})
  UNION ALL
  SELECT anomaly_type, severity, 'active', {created} FROM ({store_pattern_body(**sp)})
  UNION ALL
  SELECT anomaly_type, severity, 'active', {created} FROM ({substitution_body(**sb)}))"""


# --------------------------------------------------------------- dashboards
def _growth(today: str, yesterday: str) -> str:
    return fx(f"CASE WHEN {yesterday} > 0 THEN CAST({today} - {yesterday} AS DOUBLE) "
              f"/ CAST({yesterday} AS DOUBLE) * 100.0 ELSE 0.0 END", 2)


def executive_dashboard(hv: dict, sp: dict, sb: dict) -> str:
    """One pass over the month's baskets with a filter for each period; the 30-day block as written, i.e. over the
    baskets with items, each as often as it has items."""
    today, yesterday = date(AS_OF), date(AS_OF - dt.timedelta(days=1))
    week = f"transaction_date >= {since(7)}"
    return with_adapter(anomalies_cte(hv, sp, sb), fanned_baskets(30), f"""periods AS (
  SELECT COUNT(*) FILTER (day = {today}) AS total_transactions_today,
    {money(f'SUM(total_amount) FILTER (day = {today})')} AS revenue_today,
    COUNT(DISTINCT store_id) FILTER (day = {today}) AS active_stores_today,
    {fx(f'AVG(total_amount) FILTER (day = {today})', 6)} AS avg_transaction_today,
    {money(f'SUM(total_amount) FILTER (day = {yesterday})')} AS revenue_before,
    COUNT(*) FILTER ({week}) AS transactions_7d, {money(f'SUM(total_amount) FILTER ({week})')} AS revenue_7d,
    COUNT(DISTINCT customer_id) FILTER ({week}) AS unique_customers_7d,
    COUNT(*) FILTER (has_items) AS transactions_30d, {money('SUM(total_amount * n) FILTER (has_items)')} AS revenue_30d,
    COUNT(DISTINCT customer_id) FILTER (has_items) AS unique_customers_30d,
    {money('SUM(client_value) FILTER (has_items)')} AS client_revenue_30d,
    {money('SUM(items_value - client_value) FILTER (has_items)')} AS competitor_revenue_30d
  FROM (SELECT *, CAST(transaction_date AS DATE) AS day FROM fanned))""") + f"""
SELECT {today} AS dashboard_date, periods.* EXCLUDE (revenue_before),
  {_growth('revenue_today', 'revenue_before')} AS revenue_growth_dod_percent,
  {pct('client_revenue_30d', '(client_revenue_30d + competitor_revenue_30d)')} AS client_market_share_percent,
  (SELECT COUNT(*) FILTER (status = 'active') FROM anomalies) AS active_anomalies, devices.*
FROM periods, (SELECT COUNT(*) FILTER (status = 'active') AS active_devices,
                 COUNT(*) FILTER (status <> 'active') AS inactive_devices FROM device_master) devices"""


def store_performance_dashboard(days: int = 30, tiers=(50000, 25000, 10000)) -> str:
    """As written: a basket's amount counts once for each of its item rows and each device of the same status and
    time. Store sums are made once and multiplied by the number of such devices."""
    return with_adapter(fanned_baskets(days), f"""by_store AS (
  SELECT store_id, COUNT(*) AS baskets, SUM(total_amount * n) AS earned, {weighted_mean('total_amount', 'n')} AS mean,
    COUNT(DISTINCT customer_id) AS customers, COALESCE(SUM(n) FILTER (is_attendant_influenced), 0) AS influenced,
    COALESCE(SUM(n) FILTER (substitution_occurred), 0) AS substituted, SUM(client_value) AS client_earned
  FROM fanned GROUP BY store_id)""", """by_device AS (
  SELECT store_id, status, last_seen, COUNT(*) AS devices FROM device_master GROUP BY ALL)""", f"""combined AS (
  SELECT s.id AS store_id, s.name AS store_name, s.region, s.store_type, COALESCE(baskets, 0) AS transactions_30d,
    {money('earned * COALESCE(devices, 1)')} AS revenue_30d, {fx('mean', 6)} AS avg_transaction_value,
    COALESCE(customers, 0) AS unique_customers_30d, COALESCE(influenced, 0) * COALESCE(devices, 1) AS influenced,
    COALESCE(substituted, 0) * COALESCE(devices, 1) AS substituted, d.status AS device_status, d.last_seen,
    {money('COALESCE(client_earned, 0) * COALESCE(devices, 1)')} AS client_revenue
  FROM stores s LEFT JOIN by_store b ON b.store_id = s.id LEFT JOIN by_device d ON d.store_id = s.id)""") + f"""
SELECT * EXCLUDE (influenced, substituted), {pct('influenced', 'transactions_30d')} AS influence_rate_percent,
  {pct('substituted', 'transactions_30d')} AS substitution_rate_percent,
  {pct('client_revenue', 'revenue_30d')} AS client_share_percent,
  CASE WHEN COALESCE(revenue_30d, 0) <= 0 THEN 'No Activity'
    ELSE {level('revenue_30d', tiers, ('Underperformer', 'Average Performer', 'Strong Performer', 'Top Performer'))} END
    AS performance_tier,
  CASE WHEN device_status <> 'active' THEN 'Device Issue' END AS device_alert,
  CASE WHEN date_diff('second', last_seen, {ts(AS_OF)}) > 86400 THEN 'Connectivity Issue' END AS connectivity_alert
FROM combined"""


def customer_analytics(days: int = 30, value_cuts=(200, 100), minute_cuts=(5, 2)) -> str:
    """Ages 18 to 25 are the first group, then ten years each; all others, unknown ones too, are the last."""
    groups = "['18-25', '26-35', '36-45', '46-55', '56-65']"
    return with_adapter(f"""by_kind AS (
  SELECT gender, CASE WHEN age BETWEEN 18 AND 65 THEN {groups}[1 + (age - 16) // 10] ELSE '65+' END AS age_group, emotion,
    region, mega_region, COUNT(*) AS n, SUM(total_amount) AS spent, AVG(total_amount) AS mean,
    AVG(duration_seconds / 60.0) AS minutes, COUNT(*) FILTER (is_attendant_influenced) AS influenced,
    COUNT(*) FILTER (substitution_occurred) AS substituted
  FROM (FROM sales_interactions WHERE transaction_date >= {since(days)})
  JOIN (SELECT id AS store_id, region FROM stores) USING (store_id)
  JOIN (SELECT region, mega_region FROM ph_regions) USING (region)
  GROUP BY ALL)""") + f"""
SELECT gender, age_group, emotion, region, mega_region, n AS transaction_count, {money('spent')} AS total_spent,
  {fx('mean', 6)} AS avg_transaction_value, {fx('minutes', 6)} AS avg_duration_minutes,
  {pct('influenced', 'n')} AS influence_rate_percent, {pct('substituted', 'n')} AS substitution_rate_percent,
  {level('mean', value_cuts, ('Low Value', 'Medium Value', 'High Value'))} AS value_segment,
  {level('minutes', minute_cuts, ('Quick Buyer', 'Average Browser', 'Deliberate Shopper'))} AS shopping_behavior
FROM by_kind"""


def system_health(hv: dict, sp: dict, sb: dict, active_connections: int = 0) -> str:
    """Score: 40 for devices in use, 30 less 10 for each high anomaly (none of it without an anomaly on record, as
    written), 30 less 2 for each connection over 50."""
    c = int(active_connections)

    def n(condition: str) -> str:
        """Rows with the condition; as written a sum, so NULL over no rows."""
        return f"CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER ({condition}) END"

    connections = 30 - min(30, 2 * max(0, c - 50))
    return with_adapter(anomalies_cte(hv, sp, sb), f"""devices AS (
  SELECT COUNT(*) AS total_devices, {', '.join(n(f"status = '{x}'") + f" AS {x}_devices" for x in ('active', 'maintenance', 'offline'))},
    {n(f"date_diff('second', last_seen, {ts(AS_OF)}) > 86400")} AS stale_devices
  FROM device_master)""", f"""sales AS (
  SELECT COUNT(*) AS total_transactions_today, {n('total_amount = 0')} AS zero_amount_transactions,
    {fx('AVG(total_amount)', 6)} AS avg_transaction_amount
  FROM sales_interactions WHERE CAST(transaction_date AS DATE) = {date(AS_OF)})""", f"""found AS (
  SELECT COUNT(*) AS total_anomalies, {n("status = 'active'")} AS active_anomalies,
    {n("severity = 'high'")} AS high_severity_anomalies, {n(f"created_at >= {ts(AS_OF)}")} AS todays_anomalies
  FROM anomalies)""") + f"""
SELECT {ts(AS_OF)} AS health_check_time, devices.*, {pct('active_devices', 'total_devices')} AS device_uptime_percent,
  sales.*, found.*, CAST({c} AS BIGINT) AS active_connections,
  {fx(f'40.0 * active_devices / NULLIF(total_devices, 0) + GREATEST(0, 30 - 10 * COALESCE(high_severity_anomalies, 3)) + {connections}', 0)}
    AS overall_health_score
FROM devices, sales, found"""


def hourly_sales_patterns(days: int = 30) -> str:
    """One row a basket with its slot and its store's island group as flags, then sums over the flags."""
    islands = "".join(f", SUM(is_{g}) AS {g}_transactions" for g in ("ncr", "luzon", "visayas", "mindanao"))
    return with_adapter("""shops AS (
  SELECT stores.id AS store_id, (contains(region, 'NCR'))::INT AS is_ncr, (mega_region = 'Luzon')::INT AS is_luzon,
    (mega_region = 'Visayas')::INT AS is_visayas, (mega_region = 'Mindanao')::INT AS is_mindanao
  FROM stores JOIN ph_regions USING (region))""", f"""visits AS (
  SELECT datepart('hour', transaction_date) AS hour_of_day, datepart('dow', transaction_date) AS day_of_week, store_id,
    total_amount, COALESCE(is_attendant_influenced, false)::INT AS influenced, shops.* EXCLUDE (store_id)
  FROM sales_interactions JOIN shops USING (store_id) WHERE transaction_date >= {since(days)})""", f"""slots AS (
  SELECT hour_of_day, day_of_week, COUNT(*) AS n, SUM(total_amount) AS revenue, AVG(total_amount) AS mean,
    len(list_distinct(list(store_id))) AS shops_open, SUM(influenced) AS influenced{islands}
  FROM visits GROUP BY hour_of_day, day_of_week)""") + f"""
SELECT {big('hour_of_day')} AS hour_of_day, {big('day_of_week')} AS day_of_week, n AS transaction_count,
  CAST(revenue AS DECIMAL(38,2)) AS total_revenue, {fx('mean', 6)} AS avg_transaction_value,
  {big('shops_open')} AS active_stores, {big('influenced')} AS influenced_transactions,
  {big('ncr_transactions')} AS ncr_transactions, {big('luzon_transactions')} AS luzon_transactions,
  {big('visayas_transactions')} AS visayas_transactions, {big('mindanao_transactions')} AS mindanao_transactions
FROM slots"""


def security_dashboard(days: int = 7) -> str:
    """Each (day, table, action) once, then its events counted by joining back; people and addresses as sets."""
    return with_adapter(f"""recent AS (
  SELECT date_trunc('day', audit_ts)::DATE AS audit_date, table_name, action, user_id, ip_address
  FROM audit_log WHERE audit_ts >= {since(days, AUDIT_AS_OF)})""") + """
SELECT audit_date, table_name, action, len(list(1)) AS action_count,
  len(list_distinct(list(user_id) FILTER (user_id IS NOT NULL)))::BIGINT AS unique_users,
  len(list_distinct(list(ip_address) FILTER (ip_address IS NOT NULL)))::BIGINT AS unique_ips
FROM recent GROUP BY ALL"""


def failed_access_attempts(hours: int = 24, min_attempts: int = 5) -> str:
    """Failures numbered from both ends per client; a client counts when a failure has more than the limit before it."""
    first = ts(AUDIT_AS_OF - dt.timedelta(hours=hours))
    return with_adapter(f"""failures AS (
  SELECT ip_address, user_agent, audit_ts,
    row_number() OVER client AS nth, max(audit_ts) OVER (client ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest,
    min(audit_ts) OVER (client ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS earliest,
    lead(audit_ts) OVER client IS NULL AS is_last
  FROM (FROM audit_log WHERE action = 'FAILED_ACCESS' AND audit_ts >= {first})
  WINDOW client AS (PARTITION BY ip_address, user_agent ORDER BY audit_ts, id))""") + f"""
SELECT ip_address, user_agent, nth AS attempt_count, earliest AS first_attempt, latest AS last_attempt
FROM failures WHERE is_last AND nth > {min_attempts}"""


def store_performance_dashboard_dedup(days: int = 30, tiers=(50000, 25000, 10000)) -> str:
    tx, tb = "COALESCE(ps.tx, 0)", "CAST(COALESCE(ps.client, 0) AS DECIMAL(38,2))"
    return with_adapter(f"si30 AS (SELECT * FROM sales_interactions WHERE transaction_date >= {since(days)})",
                        f"""tb AS (
  SELECT ti.interaction_id, SUM(CASE WHEN b.name IN {FOCUS} THEN {line_rev()} ELSE 0 END) AS client_b
  FROM transaction_items ti JOIN products p ON ti.product_id = p.id JOIN brands b ON p.brand_id = b.id
  WHERE ti.interaction_id IN (SELECT interaction_id FROM si30) GROUP BY 1)""", f"""ps AS (
  SELECT si.store_id, COUNT(*) AS tx, {msum('si.total_amount')} AS rev, AVG(si.total_amount) AS av,
    COUNT(DISTINCT si.customer_id) AS cust,
    SUM(CASE WHEN si.is_attendant_influenced THEN 1 ELSE 0 END) AS infl,
    SUM(CASE WHEN si.substitution_occurred THEN 1 ELSE 0 END) AS subs,
    {msum('COALESCE(tb.client_b, 0)')} AS client
  FROM si30 si LEFT JOIN tb ON si.interaction_id = tb.interaction_id GROUP BY 1)""", """dv AS (
  SELECT store_id, COUNT(*) AS device_count, COUNT(CASE WHEN status = 'active' THEN 1 END) AS active_devices,
    MAX(last_seen) AS last_seen FROM device_master GROUP BY 1)""") + f"""
SELECT s.id AS store_id, s.name AS store_name, s.region, s.store_type, {tx} AS transactions_30d,
  ps.rev AS revenue_30d, {fx('ps.av', 6)} AS avg_transaction_value,
  COALESCE(ps.cust, 0) AS unique_customers_30d,
  {pct('COALESCE(ps.infl, 0)', tx)} AS influence_rate_percent,
  {pct('COALESCE(ps.subs, 0)', tx)} AS substitution_rate_percent,
  COALESCE(dv.device_count, 0) AS device_count, COALESCE(dv.active_devices, 0) AS active_devices, dv.last_seen,
  {tb} AS client_revenue, {pct(tb, 'ps.rev')} AS client_share_percent,
  CASE WHEN ps.rev >= {tiers[0]} THEN 'Top Performer' WHEN ps.rev >= {tiers[1]} THEN 'Strong Performer'
       WHEN ps.rev >= {tiers[2]} THEN 'Average Performer' WHEN ps.rev > 0 THEN 'Underperformer'
       ELSE 'No Activity' END AS performance_tier
FROM stores s LEFT JOIN ps ON s.id = ps.store_id LEFT JOIN dv ON s.id = dv.store_id"""


def executive_dashboard_dedup(hv: dict, sp: dict, sb: dict) -> str:
    dedup = with_adapter() + f"""
SELECT {msum('si.total_amount')} AS revenue_30d_dedup FROM sales_interactions si
WHERE si.transaction_date >= {since(30)} AND EXISTS (
  SELECT 1 FROM transaction_items ti JOIN products p ON ti.product_id = p.id JOIN brands b ON p.brand_id = b.id
  WHERE ti.interaction_id = si.interaction_id)"""
    return f"SELECT e.*, d.revenue_30d_dedup FROM ({executive_dashboard(hv, sp, sb)}) e CROSS JOIN ({dedup}) d"


def _json(fields: list[tuple]) -> str:
    """JSON text as Spark's to_json writes these flat rows (NULLs kept;
    timestamps with microseconds). Each field is
    (column, kind) or (json key, column, kind)."""
    def val(c: str, kind: str) -> str:
        if kind == "ts":
            return f"COALESCE(to_json(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')), 'null')"
        return f"COALESCE(CAST({c} AS VARCHAR), 'null')"
    norm = [f if len(f) == 3 else (f[0], f[0], f[1]) for f in fields]
    parts = " || ',' || ".join(f"'\"{key}\":' || {val(c, kind)}" for key, c, kind in norm)
    return f"('{{' || {parts} || '}}')"


def _detected(hv: dict, sp: dict, sb: dict) -> str:
    details_hv = _json([("interaction_id", "num"), ("store_id", "num"), ("amount", "num"), ("threshold", "num"),
                        ("date", "transaction_date", "ts")])
    details_sp = _json([("store_id", "num"), ("store_avg_amount", "num"), ("overall_avg_amount", "num"),
                        ("deviation_factor", "num")])
    details_sb = _json([("store_id", "num"), ("substitution_rate", "num"), ("transaction_count", "num")])
    return f"""detected AS (
  SELECT anomaly_type AS type, {details_hv} AS details, severity FROM ({high_value_body(**hv)})
  UNION ALL SELECT anomaly_type, {details_sp}, severity FROM ({store_pattern_body(**sp)})
  UNION ALL SELECT anomaly_type, {details_sb}, severity FROM ({substitution_body(**sb)}))"""


def detect_anomalies(hv: dict, sp: dict, sb: dict, first_ts: dt.datetime, run_ts: dt.datetime) -> str:
    """State after a detection run at ``run_ts`` over the rows of one at ``first_ts`` (same rules): the first run's
    active rows resolved at the run time, the new rows active. Ids hold the run time, so all differ."""
    def rows(at: dt.datetime, status: str, resolved: str) -> str:
        return (f"SELECT sha256(type || '|' || details || '|' || '{at.isoformat()}') AS id, type, details, severity, "
                f"'{status}' AS status, {ts(at)} AS created_at, {resolved} AS resolved_at FROM detected")

    return (with_adapter(_detected(hv, sp, sb)) + rows(first_ts, "resolved", ts(run_ts)) + "\nUNION ALL\n"
            + rows(run_ts, "active", "CAST(NULL AS TIMESTAMP)"))


def detect_anomalies_audit(hv: dict, sp: dict, sb: dict, run_ts: dt.datetime) -> str:
    threshold = fx(f"AVG(total_amount) + {float(hv['k'])!r} * STDDEV(total_amount)", 2)
    return with_adapter(_detected(hv, sp, sb)) + f"""
SELECT 'anomalies' AS table_name, 'DETECTION_RUN' AS action,
  '{{"suspicious_transactions":' || CAST(COUNT(*) FILTER (type = 'SUSPICIOUS_TRANSACTION') AS VARCHAR)
  || ',"unusual_patterns":' || CAST(COUNT(*) FILTER (type = 'UNUSUAL_PATTERN') AS VARCHAR)
  || ',"high_value_threshold":' || CAST((SELECT {threshold} FROM sales_interactions
       WHERE transaction_date >= {since(hv['base_days'])}) AS VARCHAR)
  || ',"detection_date":"{AS_OF.isoformat()}"}}' AS new_data, {ts(run_ts)} AS audit_ts
FROM detected"""
