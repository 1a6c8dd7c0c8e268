"""The retail data model over the driver's TPC-H-shaped tables.

``Retail`` exposes the reference's tables (brands, products, ph_regions, stores,
device_master, sales_interactions, transaction_items, audit_log) as lazy
DataFrames. Each one is a projection of a base parquet table, so Catalyst prunes
columns and pushes predicates into the scan. Frames can also be injected
directly (``Retail.from_frames``) for hand-made edge-case tests or for a
deployment where the retail tables are stored as such.

Mapping rules (fixed values of the fixture adapter):
  brand id = number after 'Brand#'; brand category by id % 6:
    0 Dairy, 1 Snacks, 2 Cleaning, 3 Food, 4 Beverages, 5 Tobacco
  product: category = p_type, is_fmcg = p_size <= 25, unit_price = p_retailprice
  region: mega region AFRICA/AMERICA -> Luzon, ASIA/EUROPE -> Visayas, else
    Mindanao; population = 5 + key; economic weight = 0.05 * (key + 1)
  store = nation; store type by key % 4:
    0 supermarket, 1 department_store, 2 convenience_store, 3 sari_sari
  device = supplier: status offline if acctbal < 0, maintenance if < 500,
    else active; last_seen 2001-07-28 12:00 if key % 7 = 0 else 2001-08-01 06:00
  interaction = order: store = customer nation; customer NULL if custkey % 10 = 0;
    time = orderdate + (orderkey % 14 + 7) hours; influenced = priority in
    (1-URGENT, 2-HIGH); substitution = status 'P'; gender F if custkey % 20 < 11;
    age = 15 + custkey % 60; emotion by custkey % 4:
    0 happy, 1 neutral, 2 satisfied, 3 curious; duration = 30 + (orderkey % 12) * 30 s
  item = lineitem (orderkey, partkey, quantity as int)
  audit = events: action error -> FAILED_ACCESS, signup -> INSERT,
    purchase -> UPDATE, else upper(event_type); ip 10.0.0.(user % 20);
    agent agent-(user % 2)
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.columns import MONEY, ts_lit
from storelens.plans.broadcast import size_checked_broadcast

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Interaction time = order date + 7..20 hours, so "time >= t" implies
# "order date > t - 1 day": a predicate on the stored column the scan can use.
_MAX_HOUR_OFFSET = dt.timedelta(days=1)


def _case(value: Column, mapping: list[tuple[object, str]], default: str) -> Column:
    expr = None
    for key, label in mapping:
        cond = value == F.lit(key)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


_CATALOGS: dict[tuple[str, int, str], "Retail"] = {}


class Retail:
    """Lazy retail frames over one scale-factor directory (or injected frames).

    ``Retail.for_dir`` returns one shared instance per (session, directory):
    the base scans (file listing, parquet footers) and the derived dimensions
    are built once per session and reused by every operator.
    """

    def __init__(self, spark: SparkSession, base_dir: str | None = None, **frames: DataFrame):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/") if base_dir else None
        self._frames = frames
        self._raw: dict[str, DataFrame] = {}

    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Retail":
        return cls(spark, None, **frames)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None,
                     names: dict[str, str] | None = None) -> "Retail":
        """Retail tables stored as such in the session catalog (a metastore
        table, a view over a JDBC source registered with ``spark.read.jdbc``
        and partitioned options, a temp view, ...). ``names`` maps retail
        table names to catalog names; missing tables stay unavailable."""
        retail_tables = ("brands", "products", "ph_regions", "stores", "device_master", "sales_interactions",
                         "transaction_items", "audit_log")
        frames = {}
        for t in retail_tables:
            name = (names or {}).get(t, t)
            full = f"{database}.{name}" if database else name
            if spark.catalog.tableExists(full):
                frames[t] = spark.table(full)
        return cls(spark, None, **frames)

    @classmethod
    def for_dir(cls, spark: SparkSession, base_dir: str) -> "Retail":
        # the application id tells a live session from a stopped one whose object number was used again
        key = (spark.sparkContext.applicationId, id(spark), base_dir.rstrip("/"))
        if key not in _CATALOGS:
            _CATALOGS[key] = cls(spark, base_dir)
        return _CATALOGS[key]

    @staticmethod
    def clear_catalogs() -> None:
        """Forget cached scans (e.g. after the base tables were rewritten)."""
        _CATALOGS.clear()

    # ------------------------------------------------------------------ base
    def raw(self, name: str) -> DataFrame:
        if self.base_dir is None:
            raise ValueError(f"no base directory to read {name!r} from")
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.base_dir}/{name}.parquet")
        return self._raw[name]

    def _injected(self, name: str) -> DataFrame | None:
        return self._frames.get(name)

    def _stored_dimension(self, name: str, df: DataFrame) -> DataFrame:
        """Write a derived, bounded dimension (brands, stores, regions) once per
        catalog as a parquet table in the shared checkpoint folder and read it
        back: later queries scan a small table (with pruning and size
        statistics for the broadcast check) instead of re-deriving it, e.g. a
        DISTINCT over the whole part table for the brands."""
        from storelens.session import scratch_path

        path = scratch_path(self.spark, f"dim-{name}")
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    # ------------------------------------------------------------ dimensions
    @cached_property
    def brands(self) -> DataFrame:
        if (df := self._injected("brands")) is not None:
            return df
        bid = F.substring(F.col("p_brand"), 7, 100).cast("int")
        derived = (self.raw("part").select(bid.alias("id"), F.col("p_brand").alias("name"))
                   .distinct()
                   .withColumn("category", _case(F.col("id") % 6, [(0, "Dairy"), (1, "Snacks"), (2, "Cleaning"),
                                                                  (3, "Food"), (4, "Beverages")], "Tobacco")))
        return self._stored_dimension("brands", derived)

    @cached_property
    def products(self) -> DataFrame:
        if (df := self._injected("products")) is not None:
            return df
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.substring(F.col("p_brand"), 7, 100).cast("int").alias("brand_id"),
            F.col("p_type").alias("category"),
            (F.col("p_size") <= 25).alias("is_fmcg"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        )

    @cached_property
    def product_dim(self) -> DataFrame:
        """products joined to brands (inner): id, name, category, is_fmcg,
        unit_price, brand_id, brand_name, brand_category."""
        brands = size_checked_broadcast(self.brands.select(
            F.col("id").alias("b_id"), F.col("name").alias("brand_name"),
            F.col("category").alias("brand_category")))
        return (self.products.join(brands, F.col("brand_id") == F.col("b_id"))
                .drop("b_id"))

    @cached_property
    def ph_regions(self) -> DataFrame:
        if (df := self._injected("ph_regions")) is not None:
            return df
        name = F.col("r_name")
        mega = (F.when(name.isin("AFRICA", "AMERICA"), F.lit("Luzon"))
                .when(name.isin("ASIA", "EUROPE"), F.lit("Visayas")).otherwise(F.lit("Mindanao")))
        return self._stored_dimension("ph_regions", self.raw("region").select(
            F.col("r_regionkey").alias("id"),
            name.alias("region"),
            mega.alias("mega_region"),
            (F.lit(5) + F.col("r_regionkey")).cast("decimal(4,2)").alias("population_millions"),
            (F.lit(0.05) * (F.col("r_regionkey") + 1)).cast("decimal(5,4)").alias("economic_weight"),
        ))

    @cached_property
    def stores(self) -> DataFrame:
        if (df := self._injected("stores")) is not None:
            return df
        region = self.raw("region").select("r_regionkey", "r_name")
        return self._stored_dimension("stores", self.raw("nation")
                                      .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                                      .select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("region"),
            _case(F.col("n_nationkey") % 4, [(0, "supermarket"), (1, "department_store"),
                                             (2, "convenience_store")], "sari_sari").alias("store_type"),
        ))

    def stores_b(self) -> DataFrame:
        """stores behind a size-checked broadcast (a store list is a small dimension)."""
        return self._stores_b

    def regions_b(self) -> DataFrame:
        return self._regions_b

    @cached_property
    def _stores_b(self) -> DataFrame:
        return size_checked_broadcast(self.stores)

    @cached_property
    def _regions_b(self) -> DataFrame:
        return size_checked_broadcast(self.ph_regions)

    @cached_property
    def device_master(self) -> DataFrame:
        if (df := self._injected("device_master")) is not None:
            return df
        bal = F.col("s_acctbal")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("device_id"),
            F.col("s_nationkey").alias("store_id"),
            F.when(bal < 0, F.lit("offline")).when(bal < 500, F.lit("maintenance"))
            .otherwise(F.lit("active")).alias("status"),
            F.when(F.col("s_suppkey") % 7 == 0, ts_lit(dt.datetime(2001, 7, 28, 12)))
            .otherwise(ts_lit(dt.datetime(2001, 8, 1, 6))).alias("last_seen"),
        )

    # ----------------------------------------------------------------- facts
    def interactions(self, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """sales_interactions with start <= transaction_date < end (either optional).

        With the fixture adapter the bounds are also applied to the stored
        order date (widened by one day), so they reach the parquet scan.
        """
        injected = self._injected("sales_interactions")
        if injected is not None:
            df = injected
            ts = F.col("transaction_date")
            if start is not None:
                df = df.where(ts >= ts_lit(start))
            if end is not None:
                df = df.where(ts < ts_lit(end))
            return df
        cond = F.lit(True)
        if start is not None:
            cond = cond & (F.col("_order_date") >= ts_lit(start - _MAX_HOUR_OFFSET)) \
                & (F.col("transaction_date") >= ts_lit(start))
        if end is not None:
            cond = cond & (F.col("_order_date") < ts_lit(end)) & (F.col("transaction_date") < ts_lit(end))
        base = self._interactions_base
        return (base.where(cond) if start is not None or end is not None else base).drop("_order_date")

    @cached_property
    def _interactions_base(self) -> DataFrame:
        """Adapter projection of orders x customer, plus the stored order date
        (``_order_date``): bounds on it are pushed through the join into the
        orders scan, bounds on ``transaction_date`` are exact."""
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderdate", "o_orderpriority")
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        ck = F.col("o_custkey")
        return orders.join(customer, ck == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("interaction_id"),
            F.col("c_nationkey").alias("store_id"),
            F.when(ck % 10 == 0, F.lit(None)).otherwise(ck).alias("customer_id"),
            (F.col("o_orderdate").cast("timestamp_ntz")
             + F.make_dt_interval(hours=(F.col("o_orderkey") % 14 + 7).cast("int"))).alias("transaction_date"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_attendant_influenced"),
            (F.col("o_orderstatus") == "P").alias("substitution_occurred"),
            F.when(ck % 20 < 11, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
            (F.lit(15) + ck % 60).cast("int").alias("age"),
            _case(ck % 4, [(0, "happy"), (1, "neutral"), (2, "satisfied")], "curious").alias("emotion"),
            (F.lit(30) + (F.col("o_orderkey") % 12) * 30).cast("long").alias("duration_seconds"),
            F.col("o_orderdate").alias("_order_date"),
        )

    @cached_property
    def transaction_items(self) -> DataFrame:
        if (df := self._injected("transaction_items")) is not None:
            return df
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("interaction_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    @cached_property
    def audit_log(self) -> DataFrame:
        if (df := self._injected("audit_log")) is not None:
            return df
        et = F.col("event_type")
        action = (F.when(et == "error", F.lit("FAILED_ACCESS")).when(et == "signup", F.lit("INSERT"))
                  .when(et == "purchase", F.lit("UPDATE")).otherwise(F.upper(et)))
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id"),
            F.lit("events").alias("table_name"),
            action.alias("action"),
            F.col("ts").alias("audit_ts"),
            F.col("props").alias("new_data"),
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 20).cast("string")).alias("ip_address"),
            F.concat(F.lit("agent-"), (F.col("user_id") % 2).cast("string")).alias("user_agent"),
        )

    def table(self, name: str) -> DataFrame:
        """Retail table by its reference name."""
        if name == "sales_interactions":
            return self.interactions()
        return getattr(self, name)
