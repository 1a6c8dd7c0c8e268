"""DuckDB oracles for the streaming rules (their batch semantics) and sinks."""

from __future__ import annotations

import datetime as dt

from storelens.oracles import views_sql
from storelens.oracles.common import PRODUCT_FIELDS, big, fx, msum, row_json, since, ts, with_adapter


def live_kpis() -> str:
    return with_adapter() + f"""
SELECT CAST(date_trunc('day', transaction_date) AS DATE) AS day, COUNT(*) AS transactions,
  {msum('total_amount')} AS revenue, {fx('AVG(total_amount)', 6)} AS avg_transaction_value
FROM (SELECT DISTINCT ON (interaction_id) * FROM sales_interactions) GROUP BY 1"""


def metric_threshold_alert(threshold: float, above: bool = True) -> str:
    op = ">" if above else "<"
    return f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, metric,
  {fx('AVG(CAST(value AS DECIMAL(18,2)))', 6)} AS avg_value, COUNT(*) AS samples
FROM (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start, event_type AS metric, value
      FROM events CROSS JOIN range(0, 5) r(k))
GROUP BY 1, 3 HAVING AVG(CAST(value AS DECIMAL(18,2))) {op} {float(threshold)!r}"""


def error_bins_body(min_errors: int) -> str:
    return f"""SELECT date_trunc('minute', ts) AS bin_start, COUNT(*) AS error_count FROM events
WHERE event_type = 'error' GROUP BY 1 HAVING COUNT(*) > {min_errors}"""


def error_burst_alert(min_errors: int) -> str:
    return f"""
SELECT time_bucket(INTERVAL 5 MINUTE, bin_start, TIMESTAMP '1970-01-01') AS period_start, COUNT(*) AS bins,
  {big('SUM(error_count)')} AS errors
FROM ({error_bins_body(min_errors)}) GROUP BY 1"""


def rate_limit_violations(max_per_minute: int) -> str:
    return f"""
SELECT date_trunc('minute', ts) AS window_start, user_id AS client, COUNT(*) AS requests
FROM events GROUP BY 1, 2 HAVING COUNT(*) > {max_per_minute}"""


def error_rate() -> str:
    share = "CAST(COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)"
    return f"""
SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS requests,
  COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS errors, {fx(share, 6)} AS error_rate,
  CASE WHEN {share} <= 0.01 THEN 'good' WHEN {share} <= 0.05 THEN 'warning' ELSE 'critical' END AS grade
FROM events GROUP BY 1"""


def freshness(now: dt.datetime, max_seconds: int = 300) -> str:
    age = f"CAST(epoch({ts(now)}) - floor(epoch(MAX(ts))) AS BIGINT)"
    return f"""
SELECT MAX(ts) AS last_event, {age} AS seconds_since_last, {age} > {max_seconds} AS stale FROM events"""


def metric_heatmap() -> str:
    return f"""
SELECT date_trunc('hour', ts) AS bucket_start, event_type AS component,
  {fx('AVG(CAST(value AS DECIMAL(18,2)))', 6)} AS avg_value, COUNT(*) AS samples
FROM events GROUP BY 1, 2"""


def cdc_diff(modified_products_cte: str) -> str:
    cols = ("name", "brand_id", "category", "is_fmcg", "unit_price")
    parts = "\nUNION ALL\n".join(
        f"SELECT n.id AS row_key, '{c}' AS column_name, CAST(o.{c} AS VARCHAR) AS old_value, "
        f"CAST(n.{c} AS VARCHAR) AS new_value FROM products o JOIN products_new n ON o.id = n.id "
        f"WHERE o.{c} IS DISTINCT FROM n.{c}" for c in cols)
    return with_adapter(modified_products_cte) + parts


def load_retail() -> str:
    return with_adapter() + "SELECT * FROM sales_interactions"


def table_select() -> str:
    return with_adapter() + "SELECT * FROM stores WHERE region = 'ASIA' ORDER BY name"


def table_select_single() -> str:
    return with_adapter() + "SELECT * FROM products WHERE id = 5 LIMIT 1"


def export_transactions() -> str:
    return with_adapter() + """
SELECT interaction_id, store_id, customer_id, transaction_date, total_amount,
  CAST(transaction_date AS DATE) AS sale_date FROM sales_interactions"""


def export_json() -> str:
    return views_sql.brand_competition(30)


def export_csv() -> str:
    return with_adapter() + "SELECT id, name, region, store_type FROM stores"


def stream_ingest_json() -> str:
    return "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def raw_zone_append(run_ts: str) -> str:
    return with_adapter() + f"""
SELECT interaction_id, store_id, total_amount, '{run_ts}' AS _ingested_at FROM sales_interactions"""


def cdc_route(modified_products_cte: str, customers_ctes: str) -> str:
    """All three routes of the product and customer changes."""
    def changes(cols: list[tuple[str, str]]) -> str:
        texts = {"bool": lambda x: f"CASE WHEN {x} THEN 'true' WHEN NOT {x} THEN 'false' END",
                 "dec": lambda x: f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"}  # a JSON number's shortest form
        entries = []
        for c, kind in sorted((c, "dec" if c == "unit_price" else k) for c, k in cols):
            o, n = (texts.get(kind, lambda x: f"CAST({x} AS VARCHAR)")(f"{a}.{c}") for a in "on")
            entries.append(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '\"{c}\":{{\"from\":' || COALESCE(to_json({o}), 'null') "
                           f"|| ',\"to\":' || COALESCE(to_json({n}), 'null') || '}}' END")
        return "'{' || concat_ws(',', " + ", ".join(entries) + ") || '}'"

    customer_fields = [("id", "num"), ("name", "str"), ("segment", "str"), ("updated_by", "str")]
    differs = lambda cols: " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c, _ in cols[1:])
    parts = []
    for table, old, new, cols, user in (("products", "products", "products_new", PRODUCT_FIELDS, "NULL"),
                                        ("customers", "customers", "customers_new", customer_fields, "n.updated_by")):
        parts.append(f"SELECT 'raw-data' AS route, '{table}' AS \"table\", 'INSERT' AS change_type, "
                     f"CAST(NULL AS VARCHAR) AS record_id, CAST(NULL AS VARCHAR) AS user_id, {row_json('n', cols)} AS payload "
                     f"FROM {new} n WHERE id NOT IN (SELECT id FROM {old})")
        parts.append(f"SELECT 'audit-trail', '{table}', 'UPDATE', CAST(n.id AS VARCHAR), CAST({user} AS VARCHAR), {changes(cols)} "
                     f"FROM {old} o JOIN {new} n ON o.id = n.id WHERE {differs(cols)}")
    parts.append(f"SELECT 'customer-changes', 'customers', CASE WHEN o.id IS NULL THEN 'INSERT' ELSE 'UPDATE' END, "
                 f"CAST(n.id AS VARCHAR), NULL, {row_json('n', customer_fields)} FROM customers_new n "
                 f"LEFT JOIN customers o ON o.id = n.id WHERE o.id IS NULL OR {differs(customer_fields)}")
    return with_adapter(modified_products_cte, customers_ctes) + "\nUNION ALL\n".join(parts)


def latency_p95() -> str:
    """Nearest rank over sorted values: position (95 n + 99) div 100."""
    return f"""
SELECT window_start, {fx("MAX(CASE WHEN position = (95 * n + 99) // 100 THEN value END)", 6)} AS p95_value,
  COUNT(*) AS samples
FROM (SELECT date_trunc('day', ts) AS window_start, value, COUNT(value) OVER day AS n,
        CASE WHEN value IS NOT NULL THEN ROW_NUMBER() OVER (day ORDER BY value NULLS LAST) END AS position
      FROM events WINDOW day AS (PARTITION BY date_trunc('day', ts)))
GROUP BY 1"""


def row_counts(views: dict[str, str]) -> str:
    """Name and number of rows of each view."""
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS name, (SELECT COUNT(*) FROM ({q})) AS row_count" for n, q in views.items())


def file_inventory() -> str:
    """A folder for each sale date."""
    return with_adapter() + """
SELECT DISTINCT 'sale_date=' || strftime(transaction_date, '%Y-%m-%d') AS folder FROM sales_interactions"""


def latency_p95_stream() -> str:
    """The windows with all their rows, and that every one's sketch answers within two in a hundred ranks."""
    return "SELECT date_trunc('day', ts) AS window_start, COUNT(*) AS samples, true AS within_two_percent FROM events GROUP BY 1"


def stream_ingest_records() -> str:
    return """
SELECT event_id, CASE WHEN event_id % 50 IN (7, 9, 11) THEN 'quarantined' ELSE 'stored' END AS fate,
  CASE event_id % 50 WHEN 7 THEN 'not a record of the schema' WHEN 9 THEN 'ts is missing'
    WHEN 11 THEN 'not a record of the schema' END AS reason,
  CASE WHEN event_id % 50 NOT IN (7, 9, 11) THEN ts END AS ts, CASE WHEN event_id % 50 NOT IN (7, 9, 11) THEN event_type END AS event_type,
  CASE WHEN event_id % 50 NOT IN (7, 9, 11) THEN value END AS value
FROM events"""


def lake_files(parts: int, age_days: int) -> str:
    """What a lake written in ``parts`` appends holds a month, all of one age: files, those worth joining, and after that."""
    return with_adapter() + f"""
SELECT strftime(transaction_date, '%Y-%m') AS sale_month, COUNT(DISTINCT interaction_id % {parts}) AS files, {age_days} AS age_days,
  'cool' AS action, CASE WHEN COUNT(DISTINCT interaction_id % {parts}) > 1 THEN COUNT(DISTINCT interaction_id % {parts}) ELSE 0 END AS to_join,
  COUNT(*) AS rows_kept, CAST(1 AS BIGINT) AS files_left
FROM sales_interactions GROUP BY 1"""


def changed_day(day: dt.date) -> str:
    return (f"(SELECT * FROM sales_interactions WHERE NOT (CAST(transaction_date AS DATE) = DATE '{day.isoformat()}' "
            "AND interaction_id % 3 = 0))")


def incremental_daily_sales(day: dt.date) -> str:
    """The view over baskets of which one day has lost a third."""
    sql = views_sql.daily_sales(90)
    assert sql.count("FROM sales_interactions si") == 1
    return sql.replace("FROM sales_interactions si", f"FROM {changed_day(day)} si")


def region_windows(day: dt.date, windows: tuple[int, ...] = (7, 30, 90)) -> str:
    return with_adapter() + "\nUNION ALL\n".join(f"""
SELECT s.region, {w} AS days, COUNT(DISTINCT s.id) AS store_count, COUNT(*) AS transactions, {msum('si.total_amount')} AS revenue,
  {fx('AVG(si.total_amount)', 6)} AS avg_transaction_value, COUNT(DISTINCT si.customer_id) AS unique_customers
FROM {changed_day(day)} si JOIN stores s ON s.id = si.store_id
WHERE si.transaction_date >= {since(w)} GROUP BY s.region""" for w in windows)


# How raw feeds are damaged: table, key, column, when, what stands there then, and what the loader says.
DAMAGE = (
    ("brands", "id", "name", "id % 7 = 3", "NULL", "name is missing"),
    ("products", "id", "unit_price", "id % 97 = 5", "'n/a'", "unit_price is no decimal(10,2)"),
    ("products", "id", "unit_price", "id % 89 = 3 AND NOT id % 97 = 5", "'-1.50'", "unit_price is negative"),
    ("products", "id", "brand_id", "id % 83 = 2", "NULL", "brand_id is missing"),
    ("ph_regions", "id", "mega_region", "id % 5 = 4", "'Atlantis'", "mega_region is unknown"),
    ("stores", "id", "store_type", "id % 11 = 7", "'kiosk'", "store_type is unknown"),
    ("device_master", "device_id", "status", "device_id % 13 = 6", "'lost'", "status is unknown"),
    ("sales_interactions", "interaction_id", "total_amount", "interaction_id % 101 = 7", "'-5'", "total_amount is negative"),
    ("sales_interactions", "interaction_id", "transaction_date", "interaction_id % 103 = 9", "'yesterday'",
     "transaction_date is no timestamp_ntz"),
    ("sales_interactions", "interaction_id", "age", "interaction_id % 107 = 11", "'400'", "age is out of range"),
    ("transaction_items", "interaction_id", "quantity", "interaction_id % 113 = 12", "'0'", "quantity is not positive"),
    ("audit_log", "id", "audit_ts", "id % 127 = 13", "''", "audit_ts is missing"),
)

#: For each table its key and a typed column whose sum shows that values came through.
MEASURES = {"brands": ("id", "id"), "products": ("id", "unit_price"), "ph_regions": ("id", "economic_weight"),
            "stores": ("id", "id"), "device_master": ("device_id", "store_id"),
            "sales_interactions": ("interaction_id", "total_amount"), "transaction_items": ("interaction_id", "quantity"),
            "audit_log": ("id", "user_id")}


def load_retail_tables() -> str:
    """Each table's rows that no damage touches: their number, the sum of their keys, and of a typed column."""
    def one(table: str) -> str:
        key, measure = MEASURES[table]
        bad = " OR ".join(f"({when})" for t, _, _, when, _, _ in DAMAGE if t == table)
        return (f"SELECT '{table}' AS table_name, COUNT(*) FILTER (NOT ({bad})) AS loaded, COUNT(*) FILTER ({bad}) AS rejected, "
                f"CAST(SUM({key}) FILTER (NOT ({bad})) AS DECIMAL(38,4)) AS key_sum, "
                f"CAST(SUM({measure}) FILTER (NOT ({bad})) AS DECIMAL(38,4)) AS measure_sum FROM {table}")

    return with_adapter() + "\nUNION ALL\n".join(one(t) for t in MEASURES)


def load_retail_rejected(columns: dict[str, list[str]]) -> str:
    """Every damaged row with all that is wrong with it, in the order of the table's columns."""
    def one(table: str) -> str:
        own = sorted((x for x in DAMAGE if x[0] == table), key=lambda x: columns[table].index(x[2]))
        says = ", ".join(f"CASE WHEN {when} THEN '{text}' END" for _, _, _, when, _, text in own)
        bad = " OR ".join(f"({when})" for _, _, _, when, _, _ in own)
        return (f"SELECT '{table}' AS table_name, CAST({own[0][1]} AS VARCHAR) AS row_key, "
                f"array_to_string(list_filter([{says}], lambda x: x IS NOT NULL), '; ') AS reasons FROM {table} WHERE {bad}")

    return with_adapter() + "\nUNION ALL\n".join(one(t) for t in MEASURES)
