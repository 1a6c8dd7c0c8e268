"""Building blocks for the DuckDB oracle SQL.

from one ``lines`` relation (sold items with their basket, store, product and brand)
or from baskets with their number of item rows, and use filters and windows on it.
CURRENT_DATE is the fixed ``as_of``; the shared number rules are: counts BIGINT, money DECIMAL(38,2), ratios/averages DOUBLE rounded through
DECIMAL(38, k+3) to k places (same rule as ``storelens.functions.fixed``).
"""

from __future__ import annotations

import datetime as dt

from storelens.params import FIXTURE_AS_OF, FIXTURE_FOCUS_BRANDS

AS_OF = FIXTURE_AS_OF

ADAPTER = """
brands AS (
  SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS id, p_brand AS name,
    CASE CAST(substr(p_brand, 7) AS INT) % 6 WHEN 0 THEN 'Dairy' WHEN 1 THEN 'Snacks' WHEN 2 THEN 'Cleaning'
      WHEN 3 THEN 'Food' WHEN 4 THEN 'Beverages' ELSE 'Tobacco' END AS category
  FROM part),
products AS (
  SELECT p_partkey AS id, p_name AS name, CAST(substr(p_brand, 7) AS INT) AS brand_id, p_type AS category,
    p_size <= 25 AS is_fmcg, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part),
ph_regions AS (
  SELECT r_regionkey AS id, r_name AS region,
    CASE WHEN r_name IN ('AFRICA','AMERICA') THEN 'Luzon' WHEN r_name IN ('ASIA','EUROPE') THEN 'Visayas'
      ELSE 'Mindanao' END AS mega_region,
    CAST(5 + r_regionkey AS DECIMAL(4,2)) AS population_millions,
    CAST(0.05 * (r_regionkey + 1) AS DECIMAL(5,4)) AS economic_weight
  FROM region),
stores AS (
  SELECT n_nationkey AS id, n_name AS name, r_name AS region,
    CASE n_nationkey % 4 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'department_store' WHEN 2 THEN 'convenience_store'
      ELSE 'sari_sari' END AS store_type
  FROM nation JOIN region ON n_regionkey = r_regionkey),
device_master AS (
  SELECT s_suppkey AS device_id, s_nationkey AS store_id,
    CASE WHEN s_acctbal < 0 THEN 'offline' WHEN s_acctbal < 500 THEN 'maintenance' ELSE 'active' END AS status,
    CASE WHEN s_suppkey % 7 = 0 THEN TIMESTAMP '2001-07-28 12:00:00' ELSE TIMESTAMP '2001-08-01 06:00:00' END AS last_seen
  FROM supplier),
sales_interactions AS (
  SELECT o_orderkey AS interaction_id, c_nationkey AS store_id,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 14 + 7) AS transaction_date,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
    o_orderpriority IN ('1-URGENT','2-HIGH') AS is_attendant_influenced,
    o_orderstatus = 'P' AS substitution_occurred,
    CASE WHEN o_custkey % 20 < 11 THEN 'F' ELSE 'M' END AS gender,
    CAST(15 + o_custkey % 60 AS INT) AS age,
    CASE o_custkey % 4 WHEN 0 THEN 'happy' WHEN 1 THEN 'neutral' WHEN 2 THEN 'satisfied' ELSE 'curious' END AS emotion,
    30 + (o_orderkey % 12) * 30 AS duration_seconds
  FROM orders JOIN customer ON o_custkey = c_custkey),
transaction_items AS (
  SELECT l_orderkey AS interaction_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity FROM lineitem),
audit_log AS (
  SELECT event_id AS id, user_id, 'events' AS table_name,
    CASE event_type WHEN 'error' THEN 'FAILED_ACCESS' WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE'
      ELSE upper(event_type) END AS action,
    ts AS audit_ts, props AS new_data, concat('10.0.0.', CAST(user_id % 20 AS VARCHAR(10))) AS ip_address,
    concat('agent-', CAST(user_id % 2 AS VARCHAR(10))) AS user_agent
  FROM events)"""


def with_adapter(*ctes: str) -> str:
    """``WITH <adapter>, <ctes...>`` prefix."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {ADAPTER.strip()}{extra}\n"


def ts(value: dt.date | dt.datetime) -> str:
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


def date(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"


def since(days: int, as_of: dt.date = AS_OF) -> str:
    """Timestamp literal of ``as_of - days`` (CURRENT_DATE - INTERVAL 'n days')."""
    return ts(dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=days))


def fx(expr: str, k: int = 2) -> str:
    """Round to k places through DECIMAL(38, k+3); DOUBLE result."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,{k + 3})), {k}) AS DOUBLE)"


def ratio(num: str, den: str, scale: float = 1.0, k: int = 2) -> str:
    return fx(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * {float(scale)!r}", k)


def pct(num: str, den: str, k: int = 2) -> str:
    return ratio(num, den, 100.0, k)


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,2))"


def msum(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DECIMAL(38,2))"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def lines(days: int) -> str:
    """Sold items of the last ``days``, each with its basket, store, product and brand; ``client``: a focus brand's."""
    return f"""lines AS (
  FROM (FROM sales_interactions WHERE transaction_date >= {since(days)})
  JOIN (SELECT id AS store_id, name AS store_name, region, store_type FROM stores) USING (store_id)
  JOIN transaction_items USING (interaction_id)
  JOIN (SELECT id AS product_id, name AS product_name, category, is_fmcg, unit_price, brand_id FROM products) USING (product_id)
  JOIN (SELECT id AS brand_id, name AS brand, category AS brand_category FROM brands) USING (brand_id)
  SELECT *, CAST(quantity * unit_price AS DECIMAL(18,2)) AS value, brand IN {FOCUS} AS client)"""


def fanned_baskets(days: int) -> str:
    """Baskets of the last ``days`` with the item rows a left join gives each (one at least) and sums over them."""
    brand_sums = ", ".join(f"COALESCE(SUM(value) FILTER (brand = '{b}'), 0) AS brand{k}"
                           for k, b in enumerate(FIXTURE_FOCUS_BRANDS[:4]))
    return lines(days) + f""",
per_basket AS (
  SELECT interaction_id, COUNT(*) AS item_rows, SUM(value) AS items_value,
    COALESCE(SUM(value) FILTER (client), 0) AS client_value, {brand_sums}
  FROM lines GROUP BY interaction_id),
fanned AS (
  SELECT s.*, r.region, COALESCE(b.item_rows, 1) AS n, b.item_rows IS NOT NULL AS has_items,
    COALESCE(b.client_value, 0) AS client_value, COALESCE(b.items_value, 0) AS items_value,
    {", ".join(f"COALESCE(b.brand{k}, 0) AS brand{k}" for k in range(4))}
  FROM (FROM sales_interactions WHERE transaction_date >= {since(days)}) s
  JOIN (SELECT id AS store_id, region FROM stores) r USING (store_id)
  LEFT JOIN per_basket b USING (interaction_id))"""


def weighted_mean(value: str, weight: str) -> str:
    return f"CAST(SUM({value} * {weight}) AS DOUBLE) / SUM({weight})"


def level(value: str, bounds: tuple, labels: tuple[str, ...], op: str = ">=") -> str:
    """One of ``labels`` (lowest first) by how many of ``bounds`` the value reaches; NULL reaches none."""
    reached = " + ".join(f"COALESCE(CAST({value} {op} {b} AS INT), 0)" for b in bounds)
    return f"{in_list(labels).replace('(', '[').replace(')', ']')}[1 + {reached}]"


def line_rev(q: str = "ti.quantity", p: str = "p.unit_price") -> str:
    return f"CAST({q} * {p} AS DECIMAL(18,2))"


def in_list(values: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


FOCUS = in_list(FIXTURE_FOCUS_BRANDS)


PRODUCT_FIELDS = [("id", "num"), ("name", "str"), ("brand_id", "num"), ("category", "str"), ("is_fmcg", "bool"),
                  ("unit_price", "num")]


def row_json(alias: str, fields: list[tuple[str, str]]) -> str:
    """JSON text of a row as Spark's to_json writes it (field order of the frame, NULL fields kept, decimals with
    their scale). Kinds: num, str, bool."""
    def val(c: str, kind: str) -> str:
        if kind == "str":
            return f"COALESCE(to_json({alias}.{c}), 'null')"
        if kind == "bool":
            return f"COALESCE(CASE WHEN {alias}.{c} THEN 'true' ELSE 'false' END, 'null')"
        return f"COALESCE(CAST({alias}.{c} AS VARCHAR), 'null')"

    parts = " || ',' || ".join(f"'\"{c}\":' || {val(c, k)}" for c, k in fields)
    return f"('{{' || {parts} || '}}')"
