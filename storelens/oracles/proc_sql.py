"""DuckDB oracles for the parameterised functions and procedures."""

from __future__ import annotations

import datetime as dt

from storelens.oracles import dash_sql, views_sql
from storelens.oracles.common import (
    AS_OF, big, date, fx, lines, money, msum, pct, since, ts, with_adapter,
)


def _regional_brands(region: str | None, days: int) -> str:
    """Revenue of each brand and region, with the region's total and the brand's place there."""
    only = "" if region is None else f"WHERE region = '{region}'"
    return with_adapter(lines(days), f"""earned AS (
  SELECT brand, region, SUM(value) AS revenue FROM lines {only} GROUP BY ALL)""", """placed AS (
  SELECT *, SUM(revenue) OVER r AS market, RANK() OVER (r ORDER BY revenue DESC) AS place
  FROM earned WINDOW r AS (PARTITION BY region))""")


def _shares(place: str, brand: str | None) -> str:
    return f"""
SELECT brand AS brand_name, region, {money('revenue')} AS total_revenue, {pct('revenue', 'market')} AS market_share_percent,
  {big(place)} AS rank_in_region
FROM placed {"" if brand is None else f"WHERE brand = '{brand}'"}"""


def get_market_share(brand: str | None = None, region: str | None = None, days: int = 30) -> str:
    """The rank is among the brands asked for."""
    return _regional_brands(region, days) + _shares("RANK() OVER (PARTITION BY region ORDER BY revenue DESC)", brand)


def market_share_ranked(brand: str | None = None, region: str | None = None, days: int = 30) -> str:
    """The rank is among all brands."""
    return _regional_brands(region, days) + _shares("place", brand)


def market_share_by_region(days: int = 90) -> str:
    client = "SUM(CASE WHEN client THEN value ELSE 0 END)"
    return with_adapter(lines(days)) + f"""
SELECT region, {money(client)} AS client_revenue, {msum('value')} AS total_revenue,
  {pct(client, 'SUM(value)')} AS client_market_share_percent
FROM lines GROUP BY region"""


def customer_insights(days: int = 30, segment_params: dict | None = None) -> str:
    """A customer was active if the last visit is late enough."""
    segments = views_sql.customer_segments(**(segment_params or {}))
    return f"""
SELECT customer_segment AS segment, COUNT(*) AS customer_count,
  {fx('AVG(avg_transaction_value)', 2)} AS avg_transaction_value, {msum('total_spent')} AS total_revenue,
  {fx('AVG(transaction_count)', 2)} AS avg_frequency
FROM ({segments}) WHERE last_transaction_date >= {since(days)} GROUP BY customer_segment"""


_FMCG_BASKETS = """fmcg_baskets AS (
  SELECT DISTINCT interaction_id FROM transaction_items SEMI JOIN (SELECT id AS product_id FROM products WHERE is_fmcg)
  USING (product_id))"""


def flag_fmcg() -> str:
    """No basket is flagged before, so those with an FMCG product are the updated ones."""
    return with_adapter(_FMCG_BASKETS) + """
SELECT s.interaction_id, CASE WHEN f.interaction_id IS NOT NULL THEN true END AS is_fmcg,
  f.interaction_id IS NOT NULL AS updated
FROM sales_interactions s LEFT JOIN fmcg_baskets f ON f.interaction_id = s.interaction_id"""


def flag_fmcg_audit(at: dt.datetime) -> str:
    return with_adapter(_FMCG_BASKETS) + f"""
SELECT 'sales_interactions' AS table_name, 'FMCG_UPDATE' AS action,
  '{{"updated_count":' || CAST(COUNT(*) AS VARCHAR) || '}}' AS new_data, {ts(at)} AS audit_ts
FROM sales_interactions SEMI JOIN fmcg_baskets USING (interaction_id)"""


def _aged_anomalies(hv: dict, sp: dict, sb: dict) -> tuple[str, str]:
    """The fixture's anomalies with some resolved: low ones long ago, medium ones lately."""
    return dash_sql.anomalies_cte(hv, sp, sb), """aged AS (
  SELECT type, severity, CASE severity WHEN 'high' THEN 'active' ELSE 'resolved' END AS state,
    CASE severity WHEN 'low' THEN TIMESTAMP '2001-04-01' WHEN 'medium' THEN TIMESTAMP '2001-07-01' END AS closed_at
  FROM anomalies)"""


def purge_old_data(retention_months: int = 12, audit_as_of: dt.date | None = None, audit_months: int = 6,
                   anomaly_months: int = 3, hv=None, sp=None, sb=None) -> str:
    """Counts of what goes, each as rows before less rows kept."""
    cut = f"{date(AS_OF)} - INTERVAL '{retention_months} months'"
    audit_cut = f"{date(audit_as_of or AS_OF)} - INTERVAL '{audit_months} months'"
    closed_cut = f"{date(AS_OF)} - INTERVAL '{anomaly_months} months'"
    return with_adapter(*_aged_anomalies(hv or {}, sp or {}, sb or {}), f"""old AS (
  SELECT interaction_id FROM sales_interactions WHERE transaction_date < {cut})""") + f"""
SELECT CAST({cut} AS DATE) AS cutoff_date,
  (SELECT COUNT(*) FROM transaction_items SEMI JOIN old USING (interaction_id)) AS deleted_items,
  (SELECT COUNT(*) FROM old) AS deleted_interactions,
  (SELECT COUNT(*) FILTER (audit_ts < {audit_cut}) FROM audit_log) AS deleted_audit_logs,
  (SELECT COUNT(*) FILTER (state = 'resolved' AND closed_at < {closed_cut}) FROM aged) AS deleted_anomalies"""


def purge_kept(table: str, retention_months: int, audit_as_of: dt.date, hv: dict, sp: dict, sb: dict) -> str:
    """Keys of the rows that stay in ``table``."""
    cut = f"{date(AS_OF)} - INTERVAL '{retention_months} months'"
    return with_adapter(*_aged_anomalies(hv, sp, sb)) + {
        "sales_interactions": f"SELECT interaction_id FROM sales_interactions WHERE NOT transaction_date < {cut}",
        "transaction_items": f"SELECT interaction_id, product_id, quantity FROM transaction_items WHERE interaction_id NOT IN "
                             f"(SELECT interaction_id FROM sales_interactions WHERE transaction_date < {cut})",
        "audit_log": f"SELECT id, audit_ts FROM audit_log WHERE audit_ts >= {date(audit_as_of)} - INTERVAL '6 months'",
        "anomalies": f"SELECT type, severity, state AS status, closed_at AS resolved_at FROM aged "
                     f"WHERE state = 'active' OR closed_at >= {date(AS_OF)} - INTERVAL '3 months'",
    }[table]


def system_alerts(hv: dict, sp: dict, sb: dict, min_idle_stores: int = 5, max_high_anomalies: int = 10) -> str:
    """A table of the alerts (fixed codes, severities and messages) with what they count and the most that is fine."""
    return with_adapter(dash_sql.anomalies_cte(hv, sp, sb), f"""counted AS (
  SELECT (SELECT COUNT(*) FROM device_master WHERE date_diff('second', last_seen, {ts(AS_OF)}) > 86400) AS stale,
    (SELECT COUNT(*) FROM (SELECT id AS store_id FROM stores) ANTI JOIN
       (FROM sales_interactions WHERE CAST(transaction_date AS DATE) = {date(AS_OF)}) USING (store_id)) AS idle,
    (SELECT COUNT(*) FILTER (status = 'active' AND severity = 'high') FROM anomalies) AS high)""") + f"""
SELECT alert_type, severity, message, CAST(found AS INTEGER) AS affected_count
FROM counted, LATERAL (VALUES
  ('DEVICE_CONNECTIVITY', 'high', 'Devices offline for more than 24 hours', stale, 0),
  ('REVENUE_ANOMALY', 'medium', 'Stores with zero revenue today', idle, {min_idle_stores}),
  ('ANOMALY_COUNT', 'high', 'High number of active anomalies', high, {max_high_anomalies}))
  alerts(alert_type, severity, message, found, fine)
WHERE found > fine"""


def security_alert(hours: int = 24, min_attempts: int = 5, threshold: int = 10) -> str:
    fa = dash_sql.failed_access_attempts(hours, min_attempts)
    return f"""
SELECT 'SECURITY_ALERT' AS type, COUNT(*) AS suspicious_ips, 'high' AS severity
FROM ({fa}) failed_access_attempts WHERE attempt_count > {threshold}"""


def hash_sensitive() -> str:
    return with_adapter() + """
SELECT interaction_id, sha256(CAST(customer_id AS VARCHAR)) AS customer_hash FROM sales_interactions"""


def table_volume_monitor() -> str:
    return with_adapter() + f"""
SELECT 'sales_interactions' AS table_name, COUNT(*) AS row_count FROM sales_interactions
UNION ALL SELECT 'transaction_items', COUNT(*) FROM transaction_items
UNION ALL SELECT 'daily_sales', (SELECT COUNT(*) FROM ({views_sql.daily_sales(90)}))
UNION ALL SELECT 'daily_sales_summary', (SELECT COUNT(*) FROM ({views_sql.daily_sales_summary(90)}))"""


def alert_payload(hv: dict, sp: dict, sb: dict) -> str:
    alerts = system_alerts(hv, sp, sb)
    row = ("'{\"alert_type\":' || to_json(alert_type) || ',\"severity\":' || to_json(severity) || "
           "',\"message\":' || to_json(message) || ',\"affected_count\":' || CAST(affected_count AS VARCHAR) || '}'")
    return f"""
SELECT 'system_alerts' AS table_name, 'ALERT_CHECK' AS action,
  CASE WHEN COUNT(*) > 0 THEN '[' || string_agg({row}, ',' ORDER BY alert_type, severity, message) || ']' END
    AS new_data,
  {ts(AS_OF)} AS audit_ts
FROM ({alerts}) alerts"""
