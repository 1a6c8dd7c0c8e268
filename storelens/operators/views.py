"""Stored analytic views (batch): each is ``(retail, as_of, **params) -> DataFrame``.

Every view states the reference semantics in its docstring; where the reference
SQL fans item rows out against basket rows, the plain function keeps that
behaviour and a ``*_dedup`` twin gives the per-basket numbers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.columns import (
    as_double, avg_money, avg_num, count_distinct, count_if, dow, fixed, hour, money_sum, pct,
    rank_desc, ratio, tier, ts_lit, whole_days,
)
from storelens.params import FIXTURE_FOCUS_BRANDS
from storelens.plans.lines import day_bounds, sales_lines, window_start, with_mega_region, with_store
from storelens.plans.scalars import with_scalars
from storelens.sources.retail import Retail


def daily_sales(r: Retail, as_of: dt.date, days: int = 90) -> DataFrame:
    """Per (sale date, store, region, store name, weekday, hour) over the last
    ``days`` days: count, revenue, average basket, influenced and substitution
    counts. Grain = the reference's unique index (date, store, weekday, hour)."""
    si = with_store(r.interactions(window_start(as_of, days)), r, ("region", "name"))
    ts = F.col("transaction_date")
    return (si.groupBy(F.to_date(ts).alias("sale_date"), "store_id", "region", F.col("name").alias("store_name"),
                       dow(ts).alias("day_of_week"), hour(ts).alias("peak_hour"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum("total_amount").alias("daily_revenue"),
                 avg_money("total_amount").alias("avg_transaction_value"),
                 count_if(F.col("is_attendant_influenced")).alias("influenced_transactions"),
                 count_if(F.col("substitution_occurred")).alias("substitution_transactions"))
            .select("sale_date", "store_id", "region", "store_name", "transaction_count", "daily_revenue",
                    "avg_transaction_value", "influenced_transactions", "substitution_transactions",
                    "day_of_week", "peak_hour"))


def product_performance(r: Retail, as_of: dt.date, days: int = 90,
                        tiers: tuple[float, float] = (1000, 500)) -> DataFrame:
    """Per product over ``days``: units, revenue, distinct baskets, mean line
    quantity, share of all revenue, rank by units within category, units per
    whole day between first and last sale, tier (strict >)."""
    lines = sales_lines(r, window_start(as_of, days))
    per_product = (lines.groupBy(F.col("product_id"), "product_name", "brand_name", "category", "is_fmcg")
                   .agg(F.sum("quantity").cast("long").alias("total_units_sold"),
                        money_sum("line_revenue").alias("total_revenue"),
                        count_distinct("interaction_id").alias("transaction_count"),
                        avg_num("quantity").alias("avg_quantity_per_transaction"),
                        F.max("transaction_date").alias("_last"), F.min("transaction_date").alias("_first")))
    # How many products of the category sold how much: rows per distinct number of units, not per product. Running
    # counts over them give each number's rank. One row per category adds up to the grand total.
    sold = (per_product.groupBy("category", "total_units_sold")
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_revenue").alias("_revenue")))
    better = F.sum("_n").over(Window.partitionBy("category").orderBy(F.col("total_units_sold").desc())) - F.col("_n")
    placed = sold.withColumn("_place", F.struct(F.col("total_units_sold").alias("_units"),
                                                (better + 1).cast("long").alias("category_rank")))
    categories = placed.groupBy("category").agg(F.sum("_revenue").alias("_of_category"), F.collect_list("_place").alias("_places"))
    standing = (categories.withColumn("_grand", F.sum("_of_category").over(Window.partitionBy()))
                .select(F.col("category").alias("_category"), "_grand", F.inline("_places")))
    days_span = whole_days("_last", "_first")
    units = F.col("total_units_sold")
    return (per_product.join(standing, F.col("category").eqNullSafe(F.col("_category"))
                             & units.eqNullSafe(F.col("_units")))
            .select("product_id", "product_name", "brand_name", "category", "is_fmcg", "total_units_sold",
                    "total_revenue", "transaction_count", "avg_quantity_per_transaction",
                    ratio("total_revenue", "_grand", 100.0, 6).alias("market_share_percent"), "category_rank",
                    ratio(units, days_span, 1.0, 6).alias("daily_velocity"),
                    tier(units, [(tiers[0], "High Performer"), (tiers[1], "Medium Performer")],
                         "Low Performer", strict=True).alias("performance_tier")))


def top_products(r: Retail, as_of: dt.date, days: int = 90, n: int = 10) -> DataFrame:
    """The ``n`` products with the most revenue over ``days`` (ties to the smaller id): only what the list shows."""
    lines = sales_lines(r, window_start(as_of, days))
    return (lines.groupBy("product_id", "product_name", "brand_name")
            .agg(F.sum("quantity").cast("long").alias("total_units_sold"), money_sum("line_revenue").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "product_id").limit(n))


def customer_segments(r: Retail, as_of: dt.date, days: int = 365,
                      monetary: tuple[float, float] = (10000, 5000),
                      frequency: tuple[int, int] = (10, 5),
                      recency_days: tuple[int, int] = (30, 90),
                      vip_days: int = 30, loyal_days: int = 60) -> DataFrame:
    """RFM segmentation per non-null customer over ``days`` (first match wins):
    VIP (>= monetary[0], >= frequency[0], seen in vip_days), Loyal (>= monetary[1],
    >= frequency[1], seen in loyal_days), Active (seen in vip_days), At Risk."""
    si = r.interactions(window_start(as_of, days)).where(F.col("customer_id").isNotNull())
    ts = F.col("transaction_date")
    m = (si.groupBy("customer_id")
         .agg(F.count(F.lit(1)).alias("transaction_count"),
              money_sum("total_amount").alias("total_spent"),
              avg_money("total_amount").alias("avg_transaction_value"),
              F.max(ts).alias("last_transaction_date"),
              (whole_days(F.max(ts), F.min(ts)) + 1).alias("customer_lifetime_days"),
              count_distinct(F.to_date(ts)).alias("active_days")))
    last = F.col("last_transaction_date")
    cnt = F.col("transaction_count")
    spent = F.col("total_spent")

    def seen_within(d: int):
        return last >= ts_lit(window_start(as_of, d))

    recency = (F.when(seen_within(recency_days[0]), "Recent").when(seen_within(recency_days[1]), "Active")
               .otherwise("Inactive"))
    freq = F.when(cnt >= frequency[0], "Frequent").when(cnt >= frequency[1], "Regular").otherwise("Occasional")
    mon = F.when(spent >= monetary[0], "Premium").when(spent >= monetary[1], "Standard").otherwise("Budget")
    combined = (F.when((spent >= monetary[0]) & (cnt >= frequency[0]) & seen_within(vip_days), "VIP")
                .when((spent >= monetary[1]) & (cnt >= frequency[1]) & seen_within(loyal_days), "Loyal")
                .when(seen_within(vip_days), "Active").otherwise("At Risk"))
    return m.select("customer_id", "transaction_count", "total_spent", "avg_transaction_value",
                    "last_transaction_date", "customer_lifetime_days", "active_days",
                    recency.alias("recency_segment"), freq.alias("frequency_segment"),
                    mon.alias("monetary_segment"), combined.alias("customer_segment"))


def _regional_finish(m: DataFrame, brand_cols: list[str]) -> DataFrame:
    focus_total = sum((F.col(c) for c in brand_cols[1:]), F.col(brand_cols[0])).cast("decimal(38,2)")
    return m.select(
        "region", "store_count", "total_transactions", "total_revenue", "avg_transaction_value",
        "unique_customers",
        ratio("total_revenue", "store_count", 1.0, 2).alias("revenue_per_store"),
        pct("influenced_sales", "total_transactions").alias("influence_rate_percent"),
        pct("substitution_events", "total_transactions").alias("substitution_rate_percent"),
        *brand_cols,
        focus_total.alias("client_total_revenue"),
        pct(focus_total, "total_revenue").alias("client_market_share_percent"),
        rank_desc("total_revenue").alias("revenue_rank"))


_REGIONAL_BRAND_COLS = ["alaska_revenue", "oishi_revenue", "peerless_revenue", "del_monte_revenue"]


def regional_performance(r: Retail, as_of: dt.date, days: int = 90,
                         brands4: tuple[str, ...] = FIXTURE_FOCUS_BRANDS[:4]) -> DataFrame:
    """Per region, as written: interactions LEFT JOIN items/products/brands, so
    basket amount and influence/substitution counts are summed once per item
    row (rates can exceed 100 %). Four brand revenue columns (first four focus
    brands), their total and share, rank by revenue."""
    lines = with_store(sales_lines(r, window_start(as_of, days), how="left"), r)
    # Level 1 per (region, store, customer): each basket has one store and one customer, so its distinct count adds up
    # over these rows. Level 2 per region and bucket of customer ids keeps the customers as a bitmap and the stores, a
    # dimension, as a set. So customers and stores are distinct without any Expand.
    per = (lines.groupBy("region", "store_id", "customer_id")
           .agg(count_distinct("interaction_id").alias("_tx"),
                F.sum("total_amount").alias("_amt"), F.count("total_amount").alias("_n"),
                count_if(F.col("is_attendant_influenced")).alias("_infl"),
                count_if(F.col("substitution_occurred")).alias("_subs"),
                *[F.sum(F.when(F.col("brand_name") == b, F.col("line_revenue")).otherwise(F.lit(0))).alias(c)
                  for b, c in zip(brands4, _REGIONAL_BRAND_COLS)]))
    sums = ["_tx", "_amt", "_n", "_infl", "_subs", *_REGIONAL_BRAND_COLS]
    customer = F.col("customer_id").cast("long")
    buckets = (per.groupBy("region", F.bitmap_bucket_number(customer).alias("_bucket"))
               .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(customer))).alias("_customers"),
                    F.collect_set("store_id").alias("_stores"), *[F.sum(c).alias(c) for c in sums]))
    m = (buckets.groupBy("region")
         .agg(F.size(F.array_distinct(F.flatten(F.collect_list("_stores")))).cast("long").alias("store_count"),
              F.sum("_tx").cast("long").alias("total_transactions"),
              F.sum("_amt").cast("decimal(38,2)").alias("total_revenue"),
              fixed(F.sum("_amt") / F.sum("_n"), 6).alias("avg_transaction_value"),
              F.sum("_customers").cast("long").alias("unique_customers"),
              F.sum("_infl").cast("long").alias("influenced_sales"),
              F.sum("_subs").cast("long").alias("substitution_events"),
              *[F.sum(c).cast("decimal(38,2)").alias(c) for c in _REGIONAL_BRAND_COLS]))
    return _regional_finish(m, _REGIONAL_BRAND_COLS)


def regional_performance_dedup(r: Retail, as_of: dt.date, days: int = 90,
                               brands4: tuple[str, ...] = FIXTURE_FOCUS_BRANDS[:4]) -> DataFrame:
    """regional_performance with items pre-aggregated per basket before the
    join, so each basket counts once (the evident intent)."""
    start = window_start(as_of, days)
    si = r.interactions(start)
    lines = sales_lines(r, interactions=si.select("interaction_id"))
    per_basket = (lines.groupBy("interaction_id")
                  .agg(*[money_sum(F.when(F.col("brand_name") == b, F.col("line_revenue")).otherwise(F.lit(0)))
                         .alias(c) for b, c in zip(brands4, _REGIONAL_BRAND_COLS)])
                  .withColumnRenamed("interaction_id", "_b_id"))
    joined = with_store(si.join(per_basket, F.col("interaction_id") == F.col("_b_id"), "left"), r)
    m = (joined.groupBy("region")
         .agg(count_distinct("store_id").alias("store_count"),
              F.count(F.lit(1)).alias("total_transactions"),
              money_sum("total_amount").alias("total_revenue"),
              avg_money("total_amount").alias("avg_transaction_value"),
              count_distinct("customer_id").alias("unique_customers"),
              count_if(F.col("is_attendant_influenced")).alias("influenced_sales"),
              count_if(F.col("substitution_occurred")).alias("substitution_events"),
              *[money_sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in _REGIONAL_BRAND_COLS]))
    return _regional_finish(m, _REGIONAL_BRAND_COLS)


def philippine_market_analysis(r: Retail, as_of: dt.date, days: int = 90,
                               focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Per (mega region, region, population, weight): distinct baskets, basket
    revenue summed per item row (fan-out as written), stores, client and
    competitor item revenue and client share."""
    lines = with_mega_region(with_store(sales_lines(r, window_start(as_of, days)), r), r)
    regions = r.regions_b().select(F.col("region").alias("_rg"), "population_millions", "economic_weight")
    lines = lines.join(regions, F.col("region") == F.col("_rg")).drop("_rg")
    focus_flag = F.col("brand_name").isin(*focus)
    keys = ["mega_region", "region", "population_millions", "economic_weight"]
    # Level 1 per store (a basket has one store): distinct baskets add up over
    # stores and each store is one row, so no multi-distinct Expand is needed.
    per_store = (lines.groupBy(*keys, "store_id")
                 .agg(count_distinct("interaction_id").alias("_tx"),
                      F.sum("total_amount").alias("_amt"), F.count("total_amount").alias("_n"),
                      F.sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_client"),
                      F.sum(F.when(~focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_comp"),
                      F.sum("line_revenue").alias("_items")))
    m = (per_store.groupBy(*keys)
         .agg(F.sum("_tx").cast("long").alias("total_transactions"),
              F.sum("_amt").cast("decimal(38,2)").alias("total_revenue"),
              fixed(F.sum("_amt") / F.sum("_n"), 6).alias("avg_transaction_value"),
              F.count(F.lit(1)).alias("active_stores"),
              F.sum("_client").cast("decimal(38,2)").alias("client_revenue"),
              F.sum("_comp").cast("decimal(38,2)").alias("competitor_revenue"),
              F.sum("_items").cast("decimal(38,2)").alias("_items")))
    return m.select("mega_region", "region", "population_millions", "economic_weight", "total_transactions",
                    "total_revenue", "avg_transaction_value", "active_stores", "client_revenue",
                    "competitor_revenue", pct("client_revenue", "_items").alias("client_market_share_percent"))


def philippine_market_analysis_dedup(r: Retail, as_of: dt.date, days: int = 90,
                                     focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """philippine_market_analysis with each basket's amount counted once
    (items summed per basket before the region aggregate)."""
    lines = sales_lines(r, window_start(as_of, days))
    focus_flag = F.col("brand_name").isin(*focus)
    per_basket = (lines.groupBy("interaction_id", "store_id", "total_amount")
                  .agg(F.sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_client"),
                       F.sum(F.when(~focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_comp"),
                       F.sum("line_revenue").alias("_items")))
    per_basket = with_mega_region(with_store(per_basket, r), r)
    regions = r.regions_b().select(F.col("region").alias("_rg"), "population_millions", "economic_weight")
    per_basket = per_basket.join(regions, F.col("region") == F.col("_rg")).drop("_rg")
    m = (per_basket.groupBy("mega_region", "region", "population_millions", "economic_weight")
         .agg(F.count(F.lit(1)).alias("total_transactions"),
              money_sum("total_amount").alias("total_revenue"),
              avg_money("total_amount").alias("avg_transaction_value"),
              count_distinct("store_id").alias("active_stores"),
              money_sum("_client").alias("client_revenue"), money_sum("_comp").alias("competitor_revenue"),
              money_sum("_items").alias("_items")))
    return m.select("mega_region", "region", "population_millions", "economic_weight", "total_transactions",
                    "total_revenue", "avg_transaction_value", "active_stores", "client_revenue",
                    "competitor_revenue", pct("client_revenue", "_items").alias("client_market_share_percent"))


def daily_sales_summary_dedup(r: Retail, as_of: dt.date, days: int = 90) -> DataFrame:
    """daily_sales_summary with each basket counted once per group: lines are
    reduced to (group, basket) first, so a basket with several items of the
    same brand and category adds its amount and influence once."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r, ("region", "store_type"))
    keys = [F.to_date("transaction_date").alias("sale_date"), "region", "store_type", "brand_name", "category"]
    per_basket = (lines.groupBy(*keys, "interaction_id", "total_amount", "is_attendant_influenced")
                  .agg(F.count(F.lit(1)).alias("_lines")))
    return (per_basket.groupBy("sale_date", "region", "store_type", "brand_name", "category")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum("total_amount").alias("daily_revenue"),
                 avg_money("total_amount").alias("avg_transaction_value"),
                 count_if(F.col("is_attendant_influenced")).alias("influenced_sales")))


def focus_brand_performance(r: Retail, as_of: dt.date, days: int = 90,
                            focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Client brands only, per (brand, product category): baskets, units,
    revenue, mean line quantity, regions reached, rank by revenue."""
    lines = with_store(sales_lines(r, window_start(as_of, days)).where(F.col("brand_name").isin(*focus)), r)
    # Level 1 per (brand, category, store): basket counts add up over stores
    # (store -> region), leaving one distinct (regions) over small rows.
    per_store = (lines.groupBy("brand_name", "category", "store_id", "region")
                 .agg(count_distinct("interaction_id").alias("_tx"), F.sum("quantity").alias("_units"),
                      F.count("quantity").alias("_lines"), F.sum("line_revenue").alias("_rev")))
    m = (per_store.groupBy("brand_name", "category")
         .agg(F.sum("_tx").cast("long").alias("transaction_count"),
              F.sum("_units").cast("long").alias("total_units_sold"),
              F.sum("_rev").cast("decimal(38,2)").alias("total_revenue"),
              fixed(as_double(F.sum("_units")) / as_double(F.sum("_lines")), 6).alias("avg_quantity_per_transaction"),
              count_distinct("region").alias("regional_presence")))
    return m.withColumn("revenue_rank", rank_desc("total_revenue"))


def brand_competition(r: Retail, as_of: dt.date, days: int = 30,
                      focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS,
                      positions: tuple[float, float, float] = (0.25, 0.15, 0.05)) -> DataFrame:
    """Per (brand, brand category): baskets, units, revenue, mean line quantity,
    regions and stores reached; revenue and volume share within the brand
    category, rank in category and overall, market position on the unrounded
    revenue share (>= .25 Leader, >= .15 Strong, >= .05 Challenger, else Niche)."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r)
    # Two-level aggregation instead of three COUNT(DISTINCT)s (which Catalyst
    # would plan as an Expand tripling the item rows): a basket belongs to one
    # store and a store to one region, so per (brand, store) the distinct
    # basket counts add up, each store is one row, and only the region count
    # stays distinct, over the much smaller (brand, store) rows.
    per_store = (lines.groupBy("brand_name", "brand_category", "store_id", "region")
                 .agg(count_distinct("interaction_id").alias("_tx"),
                      F.sum("quantity").cast("long").alias("_units"),
                      F.sum("line_revenue").alias("_rev"),
                      F.count("quantity").alias("_lines")))
    bm = (per_store.groupBy("brand_name", "brand_category")
          .agg(F.sum("_tx").cast("long").alias("transactions"),
               F.sum("_units").cast("long").alias("units_sold"),
               F.sum("_rev").cast("decimal(38,2)").alias("revenue"),
               fixed(as_double(F.sum("_units")) / as_double(F.sum("_lines")), 6).alias("avg_quantity_per_transaction"),
               count_distinct("region").alias("regional_presence"),
               F.count(F.lit(1)).alias("store_presence")))
    # Category totals as a window over the brand rows (bounded by the number of
    # brands), so the item join is computed once.
    cat = Window.partitionBy("brand_category")
    bm = bm.withColumn("_cat_rev", F.sum("revenue").over(cat)).withColumn("_cat_units", F.sum("units_sold").over(cat))
    share = as_double("revenue") / as_double("_cat_rev")
    position = (F.when(share >= positions[0], "Market Leader").when(share >= positions[1], "Strong Player")
                .when(share >= positions[2], "Challenger").otherwise("Niche Player"))
    return (bm
            .select("brand_name", "brand_category",
                    F.when(F.col("brand_name").isin(*focus), "Client").otherwise("Competitor")
                    .alias("brand_type"),
                    "transactions", "units_sold", "revenue", "avg_quantity_per_transaction",
                    "regional_presence", "store_presence",
                    pct("revenue", "_cat_rev").alias("category_market_share_percent"),
                    pct("units_sold", "_cat_units").alias("category_volume_share_percent"),
                    rank_desc("revenue", ["brand_category"]).alias("revenue_rank_in_category"),
                    rank_desc("revenue").alias("overall_revenue_rank"),
                    position.alias("market_position")))


def category_performance(r: Retail, as_of: dt.date, days: int = 30,
                         focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Per product category: baskets, units, revenue, mean *line* revenue,
    distinct products / brands / regions, client vs competitor revenue, rank."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r)
    focus_flag = F.col("brand_name").isin(*focus)
    # One pass over the item rows: the first of a basket's products of a category (smallest id) counts the basket, so
    # the distinct baskets add up over products; a product's row carries its brand and the few regions it was sold in.
    of_basket = Window.partitionBy("category", "interaction_id").orderBy("product_id")
    counted = lines.withColumn("_first", F.when(F.row_number().over(of_basket) == 1, F.lit(1)).otherwise(F.lit(0)))
    per_product = (counted.groupBy("category", "product_id", "brand_id")
                   .agg(F.sum("quantity").alias("_units"), money_sum("line_revenue").alias("_revenue"),
                        F.count("line_revenue").alias("_lines"), F.sum("_first").alias("_baskets"),
                        F.sort_array(F.collect_set("region")).alias("_regions"),
                        money_sum(F.when(focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_client"),
                        money_sum(F.when(~focus_flag, F.col("line_revenue")).otherwise(F.lit(0))).alias("_competitor")))
    per_brand = (per_product.groupBy("category", "brand_id")
                 .agg(F.sum("_units").alias("_units"), F.sum("_revenue").alias("_revenue"), F.sum("_lines").alias("_lines"),
                      F.sum("_baskets").alias("_baskets"), F.count(F.lit(1)).alias("_products"),
                      F.array_distinct(F.flatten(F.collect_set("_regions"))).alias("_regions"),
                      F.sum("_client").alias("_client"), F.sum("_competitor").alias("_competitor")))
    m = (per_brand.groupBy("category")
         .agg(F.sum("_baskets").cast("long").alias("transactions"), F.sum("_units").cast("long").alias("total_units_sold"),
              money_sum("_revenue").alias("total_revenue"), F.sum("_lines").alias("_lines"),
              F.sum("_products").cast("long").alias("product_count"), F.count("brand_id").alias("brand_count"),
              money_sum("_client").alias("client_revenue"), money_sum("_competitor").alias("competitor_revenue"),
              F.size(F.array_distinct(F.flatten(F.collect_set("_regions")))).cast("long").alias("regional_presence"))
         .withColumn("avg_revenue_per_transaction", ratio("total_revenue", "_lines", 1.0, 6)))
    return m.select("category", "transactions", "total_units_sold", "total_revenue", "avg_revenue_per_transaction",
                    "product_count", "brand_count", "client_revenue", "competitor_revenue",
                    rank_desc("total_revenue").alias("revenue_rank"), "regional_presence")


def daily_sales_summary(r: Retail, as_of: dt.date, days: int = 90) -> DataFrame:
    """Per (date, region, store type, brand, product category): distinct
    baskets, basket revenue and average summed per item row (as written),
    influenced count per item row."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r, ("region", "store_type"))
    return (lines.groupBy(F.to_date("transaction_date").alias("sale_date"), "region", "store_type",
                          "brand_name", "category")
            .agg(count_distinct("interaction_id").alias("transaction_count"),
                 money_sum("total_amount").alias("daily_revenue"),
                 avg_money("total_amount").alias("avg_transaction_value"),
                 count_if(F.col("is_attendant_influenced")).alias("influenced_sales")))


def _day_metrics(r: Retail, day: dt.date, prefix: str, with_stores: bool = True) -> DataFrame:
    start, end = day_bounds(day)
    si = r.interactions(start, end)
    aggs = [F.count(F.lit(1)).alias(f"transactions_{prefix}"),  # a basket is one row
            money_sum("total_amount").alias(f"revenue_{prefix}")]
    if with_stores:
        aggs += [count_distinct("store_id").alias(f"active_stores_{prefix}"),
                 avg_money("total_amount").alias(f"avg_transaction_{prefix}")]
    return si.agg(*aggs)


def growth_pct(today: str, yesterday: str):
    """ROUND(CASE WHEN y > 0 THEN (t - y) / y * 100 ELSE 0 END, 2)."""
    y = F.col(yesterday)
    value = (as_double(F.col(today) - y) / as_double(y)) * F.lit(100.0)
    return fixed(F.when(y > 0, value).otherwise(F.lit(0.0)), 2)


def executive_kpis(r: Retail, as_of: dt.date, days: int = 30,
                   focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS, health_score: float = 95.5) -> DataFrame:
    """One row: today's four metrics, day-over-day revenue growth, client and
    total item revenue over ``days`` and client share, constant health score."""
    today = _day_metrics(r, as_of, "today")
    yesterday = _day_metrics(r, as_of - dt.timedelta(days=1), "yesterday", with_stores=False)
    lines = sales_lines(r, window_start(as_of, days))
    brand = lines.agg(
        money_sum(F.when(F.col("brand_name").isin(*focus), F.col("line_revenue")).otherwise(F.lit(0)))
        .alias("client_revenue_30d"),
        money_sum("line_revenue").alias("total_revenue_30d"))
    return (with_scalars(today, yesterday, brand)
            .select(F.lit(as_of).alias("dashboard_date"), "transactions_today", "revenue_today",
                    "active_stores_today", "avg_transaction_today",
                    growth_pct("revenue_today", "revenue_yesterday").alias("revenue_growth_dod_percent"),
                    "client_revenue_30d", "total_revenue_30d",
                    pct("client_revenue_30d", "total_revenue_30d").alias("client_market_share_percent"),
                    F.lit(health_score).alias("system_health_score")))


def daily_revenue(r: Retail, as_of: dt.date | None = None) -> DataFrame:
    """Revenue and basket count per calendar day (whole history)."""
    si = r.interactions()
    return (si.groupBy(F.to_date("transaction_date").alias("date"))
            .agg(money_sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("transactions")))
