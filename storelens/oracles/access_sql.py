"""DuckDB oracles for row policies, grant expiry and the product guard."""

from __future__ import annotations

import datetime as dt

from storelens.oracles.common import AS_OF, PRODUCT_FIELDS, row_json, since, ts, with_adapter
from storelens.params import FIXTURE_AUDIT_AS_OF

GRANTS_CTE = """user_store_access AS (
  SELECT arg_min(id, id) AS id, user_id, store_id,
    arg_min(access_level, id) AS access_level, arg_min(granted_by, id) AS granted_by,
    arg_min(granted_at, id) AS granted_at, arg_min(expires_at, id) AS expires_at,
    arg_min(is_active, id) AS is_active
  FROM (SELECT s_suppkey AS id, CAST(s_suppkey // 4 AS BIGINT) AS user_id, CAST(s_nationkey AS INT) AS store_id,
          CASE WHEN s_suppkey % 7 = 0 THEN 'admin' WHEN s_suppkey % 7 = 1 THEN 'write' ELSE 'read' END
            AS access_level,
          CAST(1 AS BIGINT) AS granted_by, TIMESTAMP '2001-01-01 00:00:00' AS granted_at,
          CASE WHEN s_suppkey % 4 = 0 THEN TIMESTAMP '2001-06-01 00:00:00'
               WHEN s_suppkey % 4 = 1 THEN TIMESTAMP '2002-01-01 00:00:00' END AS expires_at,
          s_suppkey % 5 != 0 AS is_active
        FROM supplier)
  GROUP BY user_id, store_id)"""

SI_COLS = "interaction_id, store_id, customer_id, transaction_date, total_amount"


def _hours(hour: int, role: str) -> str:
    return "true" if (8 <= hour <= 20 or role == "db_admin") else "false"


def policy_sales_analyst(hour: int, mode: str = "as_written") -> str:
    recent = f"transaction_date >= {since(90)}"
    pred = f"({recent}) OR {_hours(hour, 'data_analyst')}" if mode == "as_written" else \
        f"({recent}) AND {_hours(hour, 'data_analyst')}"
    return with_adapter() + f"SELECT {SI_COLS} FROM sales_interactions WHERE {pred}"


def policy_sales_manager(user_id: int, hour: int, mode: str = "as_written") -> str:
    live = "" if mode != "strict" else f" AND is_active AND (expires_at IS NULL OR expires_at >= {ts(AS_OF)})"
    own = (f"store_id IN (SELECT store_id FROM user_store_access WHERE user_id = {user_id}{live}) "
           f"AND transaction_date >= {since(30)}")
    pred = f"({own}) OR {_hours(hour, 'store_manager')}" if mode == "as_written" else \
        f"({own}) AND {_hours(hour, 'store_manager')}"
    return with_adapter(GRANTS_CTE) + f"SELECT {SI_COLS} FROM sales_interactions WHERE {pred}"


def policy_items_analyst() -> str:
    return with_adapter() + f"""
SELECT interaction_id, product_id, quantity FROM transaction_items
WHERE EXISTS (SELECT 1 FROM sales_interactions si WHERE si.interaction_id = transaction_items.interaction_id
              AND si.transaction_date >= {since(90)})"""


def policy_stores_manager(user_id: int) -> str:
    return with_adapter(GRANTS_CTE) + f"""
SELECT id, name, region, store_type FROM stores
WHERE id IN (SELECT store_id FROM user_store_access WHERE user_id = {user_id})"""


def policy_devices_manager(user_id: int) -> str:
    return with_adapter(GRANTS_CTE) + f"""
SELECT device_id, store_id, status, last_seen FROM device_master
WHERE store_id IN (SELECT store_id FROM user_store_access WHERE user_id = {user_id})"""


def policy_audit_own(user_id: int) -> str:
    return with_adapter() + f"""
SELECT id, user_id, action, audit_ts FROM audit_log
WHERE user_id = {user_id} AND audit_ts >= {since(7, FIXTURE_AUDIT_AS_OF)}"""


def policy_audit_viewer() -> str:
    return with_adapter() + f"""
SELECT id, user_id, action, audit_ts FROM audit_log WHERE audit_ts >= {since(30, FIXTURE_AUDIT_AS_OF)}"""


def policy_denied(table_cols: str, table: str) -> str:
    return with_adapter() + f"SELECT {table_cols} FROM {table} WHERE false"


def expire_access(now: dt.datetime) -> str:
    return with_adapter(GRANTS_CTE) + f"""
SELECT id, user_id, store_id, access_level, expires_at,
  CASE WHEN is_active AND expires_at < {ts(now)} THEN false ELSE is_active END AS is_active
FROM user_store_access"""


MODIFIED_PRODUCTS_CTE = """products_new AS (
  SELECT id,
    CASE WHEN id % 40 = 7 THEN NULL ELSE name END AS name,
    brand_id,
    CASE WHEN id % 25 = 0 THEN upper(category) ELSE category END AS category,
    is_fmcg,
    CASE WHEN id % 10 = 0 THEN unit_price + 1 ELSE unit_price END AS unit_price
  FROM products WHERE id % 50 != 1
  UNION ALL
  SELECT id + 10000000, name, brand_id, category, is_fmcg, unit_price FROM products WHERE id % 100 = 3)"""


def audit_changes() -> str:
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c, _ in PRODUCT_FIELDS[1:])
    return with_adapter(MODIFIED_PRODUCTS_CTE) + f"""
SELECT CAST(NULL AS VARCHAR) AS user_id, 'products' AS table_name, action,
  CASE WHEN action != 'INSERT' THEN {row_json('o', PRODUCT_FIELDS)} END AS old_data,
  CASE WHEN action != 'DELETE' THEN {row_json('n', PRODUCT_FIELDS)} END AS new_data,
  CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS VARCHAR) AS user_agent, COALESCE(o.id, n.id) AS row_key
FROM (SELECT o, n, CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' WHEN {changed} THEN 'UPDATE' END AS action
      FROM products o FULL OUTER JOIN products_new n ON o.id = n.id)
WHERE action IS NOT NULL"""


def product_update_guard() -> str:
    return with_adapter(MODIFIED_PRODUCTS_CTE) + """
SELECT n.id, o.name AS old_name, o.brand_id AS old_brand_id, o.category AS old_category, o.is_fmcg AS old_is_fmcg,
  n.name AS new_name, n.brand_id AS new_brand_id, n.category AS new_category, n.is_fmcg AS new_is_fmcg
FROM products o JOIN products_new n ON o.id = n.id
WHERE NOT COALESCE(o.name = n.name AND o.brand_id = n.brand_id AND o.category = n.category
                   AND o.is_fmcg = n.is_fmcg, false)"""


GRANT_COLS = "id, user_id, store_id, access_level, granted_by, granted_at, expires_at, is_active"


def grant_access(granting_user: int, user_id: int, store_id: int, level: str, now: dt.datetime,
                 caller_is_db_admin: bool = False) -> str:
    admin = "true" if caller_is_db_admin else "false"
    return with_adapter(GRANTS_CTE, f"""auth AS (
  SELECT EXISTS (SELECT 1 FROM user_store_access WHERE user_id = {granting_user} AND store_id = {store_id}
                 AND access_level = 'admin' AND is_active) OR {admin} AS ok)""") + f"""
SELECT {GRANT_COLS} FROM user_store_access
WHERE NOT ((SELECT ok FROM auth) AND user_id = {user_id} AND store_id = {store_id})
UNION ALL
SELECT COALESCE((SELECT MAX(id) FROM user_store_access WHERE user_id = {user_id} AND store_id = {store_id}),
    CAST('0x' || substr(md5('{user_id}|{store_id}'), 1, 15) AS BIGINT)),
  CAST({user_id} AS BIGINT), CAST({store_id} AS INT), '{level}', CAST({granting_user} AS BIGINT), {ts(now)},
  CAST(NULL AS TIMESTAMP), true
WHERE (SELECT ok FROM auth)"""


def revoke_access(revoking_user: int, user_id: int, store_id: int, caller_is_db_admin: bool = False) -> str:
    admin = "true" if caller_is_db_admin else "false"
    return with_adapter(GRANTS_CTE, f"""auth AS (
  SELECT EXISTS (SELECT 1 FROM user_store_access WHERE user_id = {revoking_user} AND store_id = {store_id}
                 AND access_level = 'admin' AND is_active) OR {admin} AS ok)""") + f"""
SELECT id, user_id, store_id, access_level, granted_by, granted_at, expires_at,
  CASE WHEN user_id = {user_id} AND store_id = {store_id} AND (SELECT ok FROM auth) THEN false
       ELSE is_active END AS is_active
FROM user_store_access"""
