"""Row-level access policies, store grants and audit trails as DataFrame operators.

Policy table (the reference's row-level policies). Permissive policies of one (table, role) are
OR-ed, as PostgreSQL does; ``mode`` selects how the business-hours policy and
the grant table are read:

* ``as_written``  - business hours OR-ed in; grants read without looking at
                    is_active / expires_at (what the reference SQL does);
* ``restrictive`` - business hours AND-ed with the other policies;
* ``strict``      - restrictive, and only live grants (is_active and not
                    expired) admit rows.

A (table, role) pair with no policy sees no rows (RLS default deny).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.columns import midnight, ts_lit
from storelens.plans.broadcast import size_checked_broadcast
from storelens.plans.scalars import one_row
from storelens.sources.retail import Retail
from storelens.sources.sinks import JSON_OPTIONS

ADMIN = "db_admin"
BUSINESS_HOURS = (8, 20)

# (table, role) -> permissive policies; each is (kind, argument).
POLICIES: dict[tuple[str, str], list[tuple[str, object]]] = {
    ("sales_interactions", "db_admin"): [("all", None)],
    ("sales_interactions", "dashboard_user"): [("all", None)],
    ("sales_interactions", "data_analyst"): [("recent", 90), ("hours", None)],
    ("sales_interactions", "store_manager"): [("own_stores_recent", 30), ("hours", None)],
    ("transaction_items", "db_admin"): [("all", None)],
    ("transaction_items", "dashboard_user"): [("all", None)],
    ("transaction_items", "data_analyst"): [("basket_recent", 90)],
    ("stores", "db_admin"): [("all", None)],
    ("stores", "dashboard_user"): [("all", None)],
    ("stores", "data_analyst"): [("all", None)],
    ("stores", "store_manager"): [("own_store_id", None)],
    ("products", "db_admin"): [("all", None)],
    ("products", "dashboard_user"): [("all", None)],
    ("products", "data_analyst"): [("all", None)],
    ("products", "store_manager"): [("all", None)],
    ("device_master", "db_admin"): [("all", None)],
    ("device_master", "store_manager"): [("own_stores", None)],
    ("audit_log", "db_admin"): [("all", None)],
    ("audit_log", "audit_viewer"): [("audit_recent", 30)],
    ("audit_log", "dashboard_user"): [("audit_own", 7)],
    ("audit_log", "data_analyst"): [("audit_own", 7)],
    ("audit_log", "store_manager"): [("audit_own", 7)],
}

GRANT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("access_level", T.StringType()),
    T.StructField("granted_by", T.LongType()),
    T.StructField("granted_at", T.TimestampNTZType()),
    T.StructField("expires_at", T.TimestampNTZType()),
    T.StructField("is_active", T.BooleanType()),
])


def derived_grants(r: Retail) -> DataFrame:
    """A user_store_access table derived from the device table, so it grows
    with the data: device d grants user d // 4 access to the device's store;
    level admin when d % 7 = 0, write when d % 7 = 1, else read; inactive when
    d % 5 = 0; expired (2001-06-01) when d % 4 = 0, expiring 2002-01-01 when
    d % 4 = 1, else no expiry. One row per (user, store): the lowest device id."""
    d = F.col("s_suppkey")
    rows = r.raw("supplier").select(
        d.alias("id"), F.floor(d / 4).cast("long").alias("user_id"), F.col("s_nationkey").cast("int").alias("store_id"),
        F.when(d % 7 == 0, "admin").when(d % 7 == 1, "write").otherwise("read").alias("access_level"),
        F.lit(1).cast("long").alias("granted_by"),
        ts_lit(dt.datetime(2001, 1, 1)).alias("granted_at"),
        F.when(d % 4 == 0, ts_lit(dt.datetime(2001, 6, 1))).when(d % 4 == 1, ts_lit(dt.datetime(2002, 1, 1)))
        .alias("expires_at"),
        (d % 5 != 0).alias("is_active"))
    first = F.min(F.struct(*[F.col(c) for c in GRANT_SCHEMA.fieldNames()])).alias("_g")
    return rows.groupBy("user_id", "store_id").agg(first).select("_g.*")


def _granted_stores(grants: DataFrame, user_id: int, as_of: dt.datetime, strict: bool) -> DataFrame:
    g = grants.where(F.col("user_id") == F.lit(user_id))
    if strict:
        g = g.where(F.col("is_active") & (F.col("expires_at").isNull() | (F.col("expires_at") >= ts_lit(as_of))))
    # One user's grants: small by construction, still behind the size check.
    return size_checked_broadcast(g.select(F.col("store_id").alias("_g_store")).distinct()
                                  .withColumn("_g_hit", F.lit(True)))


def policy_start(table: str, role: str, as_of: dt.date | dt.datetime, hour: int = 12, mode: str = "as_written"
                 ) -> dt.datetime | None:
    """The earliest time that ``role`` can see in ``table`` (None: no bound). Passed to the source, it prunes the scan."""
    open_hours = BUSINESS_HOURS[0] <= hour <= BUSINESS_HOURS[1] or role == ADMIN
    days = []
    for kind, arg in POLICIES.get((table, role)) or ():
        if kind in ("recent", "own_stores_recent"):
            days.append(int(arg))
        elif kind != "hours" or (mode == "as_written" and open_hours):
            return None
    return midnight(as_of) - dt.timedelta(days=max(days)) if days else None


def apply_policy(df: DataFrame, table: str, role: str, *, r: Retail | None = None, user_id: int | None = None,
                 as_of: dt.date | dt.datetime, hour: int = 12, mode: str = "as_written",
                 grants: DataFrame | None = None, time_col: str | None = None) -> DataFrame:
    """Rows of ``df`` (a ``table`` frame) visible to ``role`` at ``hour``."""
    if mode not in ("as_written", "restrictive", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    policies = POLICIES.get((table, role))
    if not policies:
        return df.limit(0)
    now = midnight(as_of)
    in_hours = BUSINESS_HOURS[0] <= hour <= BUSINESS_HOURS[1] or role == ADMIN
    strict = mode == "strict"
    preds: list[Column] = []
    gates: list[Column] = []
    out = df
    for kind, arg in policies:
        if kind == "all":
            preds.append(F.lit(True))
        elif kind == "hours":
            (preds if mode == "as_written" else gates).append(F.lit(in_hours))
        elif kind in ("recent", "audit_recent"):
            col = time_col or ("audit_ts" if table == "audit_log" else "transaction_date")
            preds.append(F.col(col) >= ts_lit(now - dt.timedelta(days=int(arg))))
        elif kind == "audit_own":
            preds.append((F.col("user_id") == F.lit(user_id))
                         & (F.col("audit_ts") >= ts_lit(now - dt.timedelta(days=int(arg)))))
        elif kind in ("own_stores_recent", "own_stores", "own_store_id"):
            key = "id" if kind == "own_store_id" else "store_id"
            gs = _granted_stores(grants, user_id, now, strict)
            out = out.join(gs, F.col(key) == F.col("_g_store"), "left")
            cond = F.col("_g_hit").isNotNull()
            if kind == "own_stores_recent":
                cond = cond & (F.col("transaction_date") >= ts_lit(now - dt.timedelta(days=int(arg))))
            preds.append(cond)
        elif kind == "basket_recent":
            ids = (r.interactions(now - dt.timedelta(days=int(arg))).select(F.col("interaction_id").alias("_b_id"))
                   .withColumn("_b_hit", F.lit(True)))
            out = out.join(ids, F.col("interaction_id") == F.col("_b_id"), "left")
            preds.append(F.col("_b_hit").isNotNull())
        else:  # pragma: no cover
            raise ValueError(kind)
    visible = preds[0]
    for p in preds[1:]:
        visible = visible | p
    for g in gates:
        visible = visible & g
    return out.where(visible).select(*df.columns)


def expire_access(grants: DataFrame, now: dt.datetime) -> DataFrame:
    """is_active = false where expires_at < now and the grant is active (NULL
    expiry never expires)."""
    expire = F.col("is_active") & (F.col("expires_at") < ts_lit(now))
    return grants.withColumn("is_active", F.when(expire, F.lit(False)).otherwise(F.col("is_active")))


def _is_store_admin(grants: DataFrame, granting_user: int, store_id: int) -> DataFrame:
    return grants.agg(F.max(F.when((F.col("user_id") == granting_user) & (F.col("store_id") == store_id)
                                   & (F.col("access_level") == "admin") & F.col("is_active"), F.lit(True))
                            ).alias("_auth"))


def grant_id(user_id: Column, store_id: Column) -> Column:
    """The id of a new grant: a number from the hash of its user and store."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", user_id.cast("string"), store_id.cast("string"))), 1, 15), 16, 10).cast("long")


def grant_access(grants: DataFrame, granting_user: int, user_id: int, store_id: int, access_level: str = "read",
                 expires_at: dt.datetime | None = None, now: dt.datetime | None = None,
                 caller_is_db_admin: bool = False) -> tuple[DataFrame, DataFrame]:
    """Upsert on (user, store) when the caller is db_admin or holds an active
    admin grant on the store; otherwise the table is unchanged and the audit
    frame is empty (the reference raises and rolls back). Latest write wins per
    key. Returns (new grants, audit rows)."""
    now = now or dt.datetime.now()
    spark = grants.sparkSession
    auth = _is_store_admin(grants, granting_user, store_id).select(
        (F.coalesce(F.col("_auth"), F.lit(False)) | F.lit(caller_is_db_admin)).alias("_ok"))
    new_row = spark.createDataFrame(
        [(None, user_id, store_id, access_level, granting_user, now, expires_at, True)], GRANT_SCHEMA)
    new_row = new_row.withColumn("id", F.lit(None).cast("long")).where(one_row(auth).getField("_ok")).withColumn("_v", F.lit(1))
    combined = grants.withColumn("_v", F.lit(0)).unionByName(new_row)
    w = Window.partitionBy("user_id", "store_id").orderBy(F.col("_v").desc())
    # On conflict the existing row keeps its id, the new values replace the rest.
    ids = Window.partitionBy("user_id", "store_id")
    state = (combined.withColumn("_rn", F.row_number().over(w))
             .withColumn("id", F.coalesce(F.col("id"), F.max("id").over(ids), grant_id(F.col("user_id"), F.col("store_id"))))
             .where(F.col("_rn") == 1).drop("_rn", "_v"))
    audit = new_row.select(F.lit("user_store_access").alias("table_name"), F.lit("GRANT_ACCESS").alias("action"),
                           F.to_json(F.struct(F.col("user_id"), F.col("store_id"), F.col("access_level"),
                                              F.col("granted_by"))).alias("new_data"),
                           ts_lit(now).alias("audit_ts"))
    return state, audit


def revoke_access(grants: DataFrame, revoking_user: int, user_id: int, store_id: int,
                  now: dt.datetime | None = None, caller_is_db_admin: bool = False) -> tuple[DataFrame, DataFrame]:
    """is_active = false for (user, store) when the caller may revoke."""
    now = now or dt.datetime.now()
    auth = _is_store_admin(grants, revoking_user, store_id).select(
        (F.coalesce(F.col("_auth"), F.lit(False)) | F.lit(caller_is_db_admin)).alias("_ok"))
    hit = (F.col("user_id") == user_id) & (F.col("store_id") == store_id) & one_row(auth).getField("_ok")
    state = grants.withColumn("is_active", F.when(hit, F.lit(False)).otherwise(F.col("is_active")))
    audit = auth.where("_ok").select(
        F.lit("user_store_access").alias("table_name"), F.lit("REVOKE_ACCESS").alias("action"),
        F.to_json(F.struct(F.lit(user_id).alias("user_id"), F.lit(store_id).alias("store_id"),
                           F.lit(revoking_user).alias("revoked_by"))).alias("new_data"),
        ts_lit(now).alias("audit_ts"))
    return state, audit


def audit_changes(old: DataFrame, new: DataFrame, key: str, table_name: str, user_id: object = None,
                  ip_address: str | None = None, user_agent: str | None = None) -> DataFrame:
    """Snapshot diff as audit rows: INSERT (key only in new), DELETE (only in
    old), UPDATE (in both, some column differs null-safely). old_data / new_data
    are the full rows as JSON (NULL fields kept), as row_to_json gives."""
    cols = [c for c in new.columns]
    o = old.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in cols]).alias("_old"))
    n = new.select(F.col(key).alias("_k2"), F.struct(*[F.col(c) for c in cols]).alias("_new"))
    j = o.join(n, F.col("_k") == F.col("_k2"), "full_outer")
    changed = ~F.col("_old").eqNullSafe(F.col("_new"))
    op = (F.when(F.col("_k").isNull(), F.lit("INSERT")).when(F.col("_k2").isNull(), F.lit("DELETE"))
          .when(changed, F.lit("UPDATE")))
    opts = {"ignoreNullFields": "false", **JSON_OPTIONS}
    return (j.withColumn("action", op).where(F.col("action").isNotNull())
            .select(F.lit(user_id).cast("string").alias("user_id"), F.lit(table_name).alias("table_name"),
                    "action",
                    F.when(F.col("action") != "INSERT", F.to_json("_old", opts)).alias("old_data"),
                    F.when(F.col("action") != "DELETE", F.to_json("_new", opts)).alias("new_data"),
                    F.lit(ip_address).cast("string").alias("ip_address"),
                    F.lit(user_agent).cast("string").alias("user_agent"),
                    F.coalesce(F.col("_k"), F.col("_k2")).alias("row_key")))


PROTECTED_PRODUCT_COLUMNS = ("name", "brand_id", "category", "is_fmcg")


def product_update_guard(old: DataFrame, new: DataFrame, role: str = "dashboard_user") -> DataFrame:
    """Product updates a non-admin may not make: any protected column changed.
    The reference compares with ``=`` (not NULL-safe), so a NULL on either side
    also rejects. Returns the rejected (id, old and new protected values)."""
    if role == ADMIN:
        return new.limit(0).select("id")
    o = old.select(F.col("id").alias("_id"), *[F.col(c).alias(f"old_{c}") for c in PROTECTED_PRODUCT_COLUMNS])
    n = new.select("id", *[F.col(c).alias(f"new_{c}") for c in PROTECTED_PRODUCT_COLUMNS])
    same = None
    for c in PROTECTED_PRODUCT_COLUMNS:
        eq = F.col(f"old_{c}") == F.col(f"new_{c}")
        same = eq if same is None else same & eq
    return (o.join(n, F.col("_id") == F.col("id")).where(~F.coalesce(same, F.lit(False))).drop("_id")
            .select("id", *[f"old_{c}" for c in PROTECTED_PRODUCT_COLUMNS],
                    *[f"new_{c}" for c in PROTECTED_PRODUCT_COLUMNS]))
