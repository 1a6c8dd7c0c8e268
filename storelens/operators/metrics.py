"""Spec, UI and validation metrics (dashboard cards, charts, slices, checks).

Where the reference gives only a card title (UI components), the metric is
defined here from its evident meaning; every such choice is stated in the
function docstring.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.columns import (
    as_double, count_distinct, count_if, count_when, fixed, midnight, money_sum, pct, ratio, ts_lit,
)
from storelens.operators.dashboards import _age_group
from storelens.params import FIXTURE_FOCUS_BRANDS
from storelens.plans.scalars import with_scalars
from storelens.plans.lines import sales_lines, window_start, with_mega_region, with_store
from storelens.sources.retail import Retail


# ----------------------------------------------------------------- KPI cards
def kpi_cards(r: Retail, date_from: dt.date | None = None, date_to: dt.date | None = None,
              regions: tuple[str, ...] | None = None, categories: tuple[str, ...] | None = None,
              brands: tuple[str, ...] | None = None) -> DataFrame:
    """Revenue, transactions, average order value and units sold under the
    global filters (inclusive date range, store regions, product categories,
    brand names). NULL or empty filters mean no filter. Category and brand
    filters keep the baskets that contain a matching item, and count only the
    matching items' units."""
    start = midnight(date_from) if date_from else None
    end = midnight(date_to) + dt.timedelta(days=1) if date_to else None
    si = r.interactions(start, end)
    if regions:
        si = with_store(si, r).where(F.col("region").isin(*regions))
    item_filter = F.lit(True)
    if categories:
        item_filter = item_filter & F.col("category").isin(*categories)
    if brands:
        item_filter = item_filter & F.col("brand_name").isin(*brands)
    # The amount travels with the basket through the item join, so baskets are read once. With an item filter only
    # matching items (the filter reaches the product scan) and their baskets are left; without one every basket stays.
    baskets = si.select("interaction_id", "total_amount")
    if categories or brands:
        lines, known = sales_lines(r, interactions=baskets).where(item_filter), F.lit(True)
    else:
        lines, known = sales_lines(r, interactions=baskets, how="left"), F.col("unit_price").isNotNull()
    per_basket = lines.groupBy("interaction_id").agg(F.max("total_amount").alias("amount"),
                                                     F.sum(F.when(known, F.col("quantity"))).alias("_units"))
    return per_basket.agg(money_sum("amount").alias("total_revenue"), F.count(F.lit(1)).alias("transactions"),
                          fixed(F.avg("amount"), 6).alias("avg_order_value"),
                          F.sum("_units").cast("long").alias("units_sold"))


def revenue_trend(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    """Revenue per calendar day over the last ``days`` days."""
    si = r.interactions(window_start(as_of, days))
    return (si.groupBy(F.to_date("transaction_date").alias("date"))
            .agg(money_sum("total_amount").alias("revenue")).orderBy("date"))


def _item_revenue(r: Retail) -> DataFrame:
    items = r.transaction_items
    prods = r.product_dim.select(F.col("id").alias("_p"), "category", "brand_name", "unit_price")
    return (items.join(prods, F.col("product_id") == F.col("_p"))
            .withColumn("total_price", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")))


def category_top(r: Retail, n: int = 10) -> DataFrame:
    """Item revenue by product category, top n (ties broken by name)."""
    return (_item_revenue(r).groupBy("category").agg(money_sum("total_price").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("category")).limit(n))


def brand_top(r: Retail, n: int = 8) -> DataFrame:
    """Item revenue by brand, top n (ties broken by name)."""
    return (_item_revenue(r).groupBy(F.col("brand_name").alias("name"))
            .agg(money_sum("total_price").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("name")).limit(n))


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """ORDER BY ... LIMIT n over a stored view (a top-k read)."""
    return df.orderBy(*order).limit(n)


# ----------------------------------------------------- chart projections
def hour_distribution(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("hour_of_day").agg(F.sum("transaction_count").cast("long").alias("transaction_count"),
                                             F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"))


def dow_distribution(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("day_of_week").agg(F.sum("transaction_count").cast("long").alias("transaction_count"),
                                             F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"))


def share_table(df: DataFrame, group: str) -> DataFrame:
    """Count per group and its percentage of all rows."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("count"))
    # The grouped frame has one row per group value (a small dimension), so the
    # total is a window over it rather than a second pass over ``df``.
    return counts.select(group, "count", pct("count", F.sum("count").over(Window.partitionBy())).alias("percent"))


def age_distribution(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    si = r.interactions(window_start(as_of, days)).withColumn("age_group", _age_group(F.col("age")))
    return share_table(si, "age_group")


def gender_distribution(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    return share_table(r.interactions(window_start(as_of, days)), "gender")


# ------------------------------------------------------- period comparisons
def _periods(as_of: dt.date, days: int) -> tuple[F.Column, F.Column]:
    ts = F.col("transaction_date")
    cur = ts >= ts_lit(window_start(as_of, days))
    prev = (ts >= ts_lit(window_start(as_of, 2 * days))) & ~cur
    return cur, prev


def period_over_period(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    """Baskets and revenue in the last ``days`` days against the ``days``
    before them, with % change (NULL when the previous period is empty)."""
    si = r.interactions(window_start(as_of, 2 * days))
    cur, prev = _periods(as_of, days)
    m = si.agg(count_when(cur).alias("current_transactions"), count_when(prev).alias("previous_transactions"),
               money_sum(F.when(cur, F.col("total_amount"))).alias("current_revenue"),
               money_sum(F.when(prev, F.col("total_amount"))).alias("previous_revenue"))
    return m.select("*",
                    pct(F.col("current_transactions") - F.col("previous_transactions"), "previous_transactions")
                    .alias("transaction_change_percent"),
                    pct(F.col("current_revenue") - F.col("previous_revenue"), "previous_revenue")
                    .alias("revenue_change_percent"))


def category_mix_trend(r: Retail, as_of: dt.date, days: int = 30, band: float = 1.0) -> DataFrame:
    """Item revenue share per product category now and in the previous
    period; trend up / down when the share moved by more than ``band`` points
    (our cut-off), else stable."""
    lines = sales_lines(r, window_start(as_of, 2 * days))
    cur, prev = _periods(as_of, days)
    rev = F.col("line_revenue")
    per_cat = lines.groupBy("category").agg(
        money_sum(F.when(cur, rev).otherwise(F.lit(0))).alias("current_revenue"),
        money_sum(F.when(prev, rev).otherwise(F.lit(0))).alias("previous_revenue"))
    everything = Window.partitionBy()  # over the per-category rows (bounded by the category list)
    j = (per_cat.withColumn("_ct", F.sum("current_revenue").over(everything))
         .withColumn("_pt", F.sum("previous_revenue").over(everything)))
    cs = as_double("current_revenue") / F.when(as_double("_ct") != 0, as_double("_ct")) * 100.0
    ps = as_double("previous_revenue") / F.when(as_double("_pt") != 0, as_double("_pt")) * 100.0
    delta = cs - ps
    return j.select("category", "current_revenue", "previous_revenue",
                    fixed(cs, 2).alias("current_share_percent"), fixed(ps, 2).alias("previous_share_percent"),
                    fixed(delta, 2).alias("share_change_points"),
                    F.when(delta > band, "up").when(delta < -band, "down").otherwise("stable").alias("trend"))


def brand_mix(r: Retail, as_of: dt.date, days: int = 30) -> DataFrame:
    """Per brand: products sold (SKU count) now, item revenue now and before,
    share of current revenue, growth % against the previous period."""
    lines = sales_lines(r, window_start(as_of, 2 * days))
    cur, prev = _periods(as_of, days)
    rev = F.col("line_revenue")
    per_brand = lines.groupBy("brand_name").agg(
        count_distinct(F.when(cur, F.col("product_id"))).alias("sku_count"),
        money_sum(F.when(cur, rev).otherwise(F.lit(0))).alias("current_revenue"),
        money_sum(F.when(prev, rev).otherwise(F.lit(0))).alias("previous_revenue"))
    # Total over the per-brand rows (bounded by the brand list): a window, not a second pass.
    return per_brand.withColumn("_t", F.sum("current_revenue").over(Window.partitionBy())).select(
        "brand_name", "sku_count", "current_revenue", "previous_revenue",
        pct("current_revenue", "_t").alias("revenue_share_percent"),
        pct(F.col("current_revenue") - F.col("previous_revenue"), "previous_revenue").alias("growth_percent"))


# ------------------------------------------------------- customer behaviour
def bundle_rate(r: Retail, as_of: dt.date, days: int = 90, focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS,
                min_products: int = 2) -> DataFrame:
    """Share of customers (with a basket in ``days``) who bought at least
    ``min_products`` distinct client-brand products in one basket."""
    lines = sales_lines(r, window_start(as_of, days)).where(F.col("customer_id").isNotNull())
    per_basket = (lines.groupBy("customer_id", "interaction_id")
                  .agg(count_distinct(F.when(F.col("brand_name").isin(*focus), F.col("product_id"))).alias("_n")))
    per_customer = per_basket.groupBy("customer_id").agg(F.max("_n").alias("_best"))
    m = per_customer.agg(F.count(F.lit(1)).alias("customers"),
                         count_when(F.col("_best") >= min_products).alias("bundling_customers"))
    return m.withColumn("bundle_rate_percent", pct("bundling_customers", "customers"))


def repeat_rate(r: Retail, as_of: dt.date, days: int = 365, within_days: int = 30) -> DataFrame:
    """Share of customers (baskets in ``days``) with some purchase followed by
    their next one within ``within_days`` days.

    Two consecutive purchases are at most W apart iff some pair is; with
    purchases bucketed into W-day blocks that is: a block holding two purchases,
    or the first purchase of a block within W of the last one of the block
    before. Blocks are a per-customer aggregate (bounded by the time span), so
    no customer's whole history is ever sorted in one task.
    """
    si = r.interactions(window_start(as_of, days)).where(F.col("customer_id").isNotNull())
    secs = F.col("transaction_date").cast("timestamp").cast("long")
    w = within_days * 86400
    blocks = (si.groupBy("customer_id", F.floor(secs / w).alias("block"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min(secs).alias("_first"), F.max(secs).alias("_last")))
    nxt = blocks.select(F.col("customer_id").alias("_c"), (F.col("block") - 1).alias("_b"),
                        F.col("_first").alias("_next_first"))
    pairs = blocks.join(nxt, (F.col("customer_id") == F.col("_c")) & (F.col("block") == F.col("_b")), "left")
    hit = (F.col("_n") >= 2) | (F.col("_next_first") - F.col("_last") <= w)
    per_customer = pairs.groupBy("customer_id").agg(F.max(F.coalesce(hit, F.lit(False))).alias("_repeat"))
    m = per_customer.agg(F.count(F.lit(1)).alias("customers"), count_when(F.col("_repeat")).alias("repeat_customers"))
    return m.withColumn("repeat_rate_percent", pct("repeat_customers", "customers"))


def regional_affinity(r: Retail, as_of: dt.date, days: int = 90,
                      focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Client share of item revenue per mega region and that share as a % of
    the highest mega region's share (a window over three rows)."""
    lines = with_mega_region(with_store(sales_lines(r, window_start(as_of, days)), r), r)
    m = lines.groupBy("mega_region").agg(
        money_sum(F.when(F.col("brand_name").isin(*focus), F.col("line_revenue")).otherwise(F.lit(0)))
        .alias("client_revenue"), money_sum("line_revenue").alias("total_revenue"))
    share = as_double("client_revenue") / F.when(as_double("total_revenue") != 0, as_double("total_revenue")) * 100.0
    m = m.withColumn("_share", share)
    best = F.max("_share").over(Window.partitionBy())
    return m.select("mega_region", "client_revenue", "total_revenue", fixed("_share", 2).alias("client_market_share_percent"),
                    fixed(F.col("_share") / F.when(best != 0, best) * 100.0, 2).alias("affinity_percent_of_max"))


def cohort_retention(r: Retail) -> DataFrame:
    """Customers by first-purchase month x months since it: distinct active
    customers. Purchases are first reduced to (customer, month), so the
    per-customer minimum runs over at most one row per month."""
    si = r.interactions().where(F.col("customer_id").isNotNull())
    months = si.select("customer_id", F.trunc(F.to_date("transaction_date"), "month").alias("month")).distinct()
    first = months.groupBy(F.col("customer_id").alias("_c")).agg(F.min("month").alias("cohort_month"))
    j = months.join(first, F.col("customer_id") == F.col("_c"))
    since = F.months_between(F.col("month"), F.col("cohort_month")).cast("long")
    return (j.groupBy("cohort_month", since.alias("months_since"))
            .agg(F.count(F.lit(1)).alias("active_customers")))


def focus_brand_by_region(r: Retail, as_of: dt.date, days: int = 90, n: int = 20,
                          focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS) -> DataFrame:
    """Client-brand item revenue per (region, brand) and its share of the
    region's item revenue, top n by revenue (intent of the README sample)."""
    lines = with_store(sales_lines(r, window_start(as_of, days)), r)
    per = lines.groupBy("region", "brand_name").agg(money_sum("line_revenue").alias("revenue"))
    per = per.withColumn("_rt", F.sum("revenue").over(Window.partitionBy("region")))
    return (per.where(F.col("brand_name").isin(*focus))
            .select("region", "brand_name", "revenue", pct("revenue", "_rt").alias("market_share_percent"))
            .orderBy(F.col("revenue").desc(), "region", "brand_name").limit(n))


def demographic_spend(customer_analytics: DataFrame) -> DataFrame:
    """customer_analytics re-aggregated per (age group, gender)."""
    return (customer_analytics.groupBy("age_group", "gender")
            .agg(fixed(F.avg("avg_transaction_value"), 6).alias("avg_spend"),
                 F.sum("transaction_count").cast("long").alias("total_transactions"),
                 fixed(F.avg("influence_rate_percent"), 2).alias("avg_influence_rate")))


def category_competition(brand_competition: DataFrame,
                         categories: tuple[str, ...] = ("Dairy", "Snacks", "Cleaning", "Beverages")) -> DataFrame:
    """Brand share rows of four brand categories, ordered by category and share."""
    return (brand_competition.where(F.col("brand_category").isin(*categories))
            .select("brand_category", "brand_name", "brand_type", "category_market_share_percent", "market_position")
            .orderBy("brand_category", F.col("category_market_share_percent").desc()))


# ---------------------------------------------------------- lookups / text
# Unit conversions (pcs = 1, pack = 10) and the localised terms
# (yelo -> ice, asin -> salt, tingi -> sachet).
UNIT_CONVERSIONS = (("pcs", 1), ("pack", 10))
LOCAL_TERMS = (("yelo", "ice"), ("asin", "salt"), ("tingi", "sachet"))


def unit_convert(items: DataFrame, unit_col: str = "unit") -> DataFrame:
    """quantity_pcs = quantity x conversion of the item's unit (a two-row
    lookup, broadcast). Unknown units give NULL."""
    spark = items.sparkSession
    conv = spark.createDataFrame(list(UNIT_CONVERSIONS), "_unit string, _factor int")
    return (items.join(F.broadcast(conv), F.col(unit_col) == F.col("_unit"), "left")
            .withColumn("quantity_pcs", (F.col("quantity") * F.col("_factor")).cast("long"))
            .drop("_unit", "_factor"))


def term_localize(c: str | F.Column) -> F.Column:
    """Replace the unbranded local terms by their English names (whole words,
    any case)."""
    col = F.col(c) if isinstance(c, str) else c
    for term, repl in LOCAL_TERMS:
        col = F.regexp_replace(col, rf"(?i)\b{term}\b", repl)
    return col


# ------------------------------------------------------ validation checks
def dq_score(r: Retail, now: dt.datetime, null_pct_max: float = 5.0, avg_range: tuple[float, float] = (20, 500),
             zero_max: int = 100) -> DataFrame:
    """One row per data-quality check (value, passed, penalty) plus the score
    row: 100 - 20 (NULL amount % > 5) - 10 (average outside range) - 10 (more
    than 100 zero amounts) - 15 (future-dated baskets) - 15 (orphan items)."""
    si = r.interactions()
    amt = F.col("total_amount")
    stats = si.agg(
        pct(count_if(amt.isNull()), F.count(F.lit(1))).alias("null_pct"),
        F.avg(amt).alias("_avg"),
        count_when(amt == 0).alias("zero_count"),
        count_when(F.col("transaction_date") > ts_lit(now)).alias("future_count"))
    orphans = (r.transaction_items.join(si.select(F.col("interaction_id").alias("_i")),
                                        F.col("interaction_id") == F.col("_i"), "left_anti")
               .agg(F.count(F.lit(1)).alias("orphan_count")))
    s = with_scalars(stats, orphans)
    avg_ok = F.col("_avg").between(avg_range[0], avg_range[1])
    checks = [
        ("null_percentage", F.col("null_pct"), ~(F.col("null_pct") > null_pct_max), 20),
        ("avg_transaction_amount", fixed("_avg", 2), F.coalesce(avg_ok, F.lit(False)), 10),
        ("zero_amount_transactions", as_double("zero_count"), ~(F.col("zero_count") > zero_max), 10),
        ("future_transactions", as_double("future_count"), ~(F.col("future_count") > 0), 15),
        ("orphaned_items", as_double("orphan_count"), ~(F.col("orphan_count") > 0), 15),
    ]
    # All checks come from the one stats row: one struct per check, plus the
    # score, exploded into rows (no union re-reading the stats branches).
    def check(name, value, passed, penalty):
        return F.struct(F.lit(name).alias("check_name"), value.cast("double").alias("value"),
                        passed.alias("passed"), penalty.cast("long").alias("penalty"))

    structs, penalties = [], []
    for name, value, ok, pen in checks:
        passed = F.coalesce(ok, F.lit(True))
        penalty = F.when(passed, F.lit(0)).otherwise(F.lit(pen))
        structs.append(check(name, value, passed, penalty))
        penalties.append(penalty)
    score = F.lit(100) - sum(penalties[1:], penalties[0])
    structs.append(check("data_quality_score", score, score >= 0, F.lit(0)))
    return s.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def market_checks(r: Retail, focus: tuple[str, ...] = FIXTURE_FOCUS_BRANDS, min_regions: int = 15,
                  share_range: tuple[float, float] = (55, 75)) -> DataFrame:
    """Regional coverage, client / competitor brand counts, item revenue split
    and whether the client share lies in the expected range."""
    regions = r.stores.agg(count_distinct("region").alias("region_count"))
    brands = r.brands.agg(count_when(F.col("name").isin(*focus)).alias("client_brands"),
                          count_when(~F.col("name").isin(*focus)).alias("competitor_brands"))
    split = _item_revenue(r).agg(money_sum(F.when(F.col("brand_name").isin(*focus), F.col("total_price")).otherwise(F.lit(0)))
                    .alias("client_revenue"),
                    money_sum(F.when(~F.col("brand_name").isin(*focus), F.col("total_price")).otherwise(F.lit(0)))
                    .alias("competitor_revenue"))
    m = with_scalars(regions, brands, split)
    share = pct("client_revenue", F.col("client_revenue") + F.col("competitor_revenue"))
    return m.select("region_count", (F.col("region_count") >= min_regions).alias("regional_coverage_ok"),
                    "client_brands", "competitor_brands", "client_revenue", "competitor_revenue",
                    share.alias("client_market_share_percent"),
                    share.between(share_range[0], share_range[1]).alias("share_in_range"))


def deployment_score(r: Retail, views: dict[str, DataFrame], min_interactions: int = 5000,
                     min_revenue: float = 1_000_000) -> DataFrame:
    """Weighted validation score without the catalog-existence terms: 20 for
    >= min_interactions baskets, 15 for revenue > min_revenue, 15 for each
    non-empty view given; grade >= 90 Excellent, >= 75 Good, >= 60 Acceptable,
    else Failed."""
    base = r.interactions().agg(F.count(F.lit(1)).alias("total_interactions"),
                                money_sum("total_amount").alias("total_revenue"))
    out = base.select("*", ratio("total_revenue", "total_interactions", 1.0, 2).alias("avg_transaction_value"),
                      (F.when(F.col("total_interactions") >= min_interactions, 20).otherwise(0)
                       + F.when(F.col("total_revenue") > min_revenue, 15).otherwise(0)).alias("_score"))
    for name, df in views.items():
        present = df.limit(1).agg((F.count(F.lit(1)) > 0).alias(f"{name}_present"))
        out = with_scalars(out, present).withColumn("_score", F.col("_score")
                                                + F.when(F.col(f"{name}_present"), 15).otherwise(0))
    score = F.col("validation_score")
    return out.withColumn("validation_score", F.col("_score").cast("long")).drop("_score").withColumn(
        "grade", F.when(score >= 90, "Excellent").when(score >= 75, "Good").when(score >= 60, "Acceptable")
        .otherwise("Failed"))


def table_presence(r: Retail, expected: tuple[str, ...]) -> DataFrame:
    """Expected retail tables: present (readable in this deployment) and row
    count; missing tables get present = false and NULL count."""
    spark = r.spark
    parts = []
    for name in expected:
        try:
            df = r.table(name)
        except (KeyError, ValueError, AttributeError, AnalysisException) as e:
            # not a table here, or its files are not there: the finding; any other fault is an error
            if isinstance(e, AnalysisException) and e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            parts.append(spark.createDataFrame([(name, False, None)], "table_name string, present boolean, "
                                                                      "row_count long"))
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), F.lit(True).alias("present"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_reconcile(a: DataFrame, b: DataFrame, a_name: str = "source", b_name: str = "target") -> DataFrame:
    """Row counts of two frames and whether they agree."""
    ca = a.agg(F.count(F.lit(1)).alias(f"{a_name}_count"))
    cb = b.agg(F.count(F.lit(1)).alias(f"{b_name}_count"))
    return with_scalars(ca, cb).withColumn("counts_match", F.col(f"{a_name}_count") == F.col(f"{b_name}_count"))
