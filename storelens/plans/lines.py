"""Shared sub-plans: the item-level sales join most views start from.

Join order is chosen for scale: the date-filtered interactions go first, so the
runtime bloom filter built from them prunes the line scan before its shuffle on
interaction_id; products come after (a shuffle on product id, or a broadcast
when the optimizer's estimate of the product frame is small).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import MONEY, midnight
from storelens.sources.retail import Retail


def window_start(as_of: dt.date, days: int) -> dt.datetime:
    return midnight(as_of) - dt.timedelta(days=days)


def day_bounds(day: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """[day, day + 1) — a range predicate instead of DATE(ts) = day, so the
    bound reaches the scan's min/max statistics."""
    start = midnight(day)
    return start, start + dt.timedelta(days=1)


def with_store(df: DataFrame, r: Retail, cols: tuple[str, ...] = ("region",), how: str = "inner") -> DataFrame:
    """Attach store attributes (stores is a small dimension: size-checked broadcast)."""
    stores = r.stores_b().select(F.col("id").alias("_s_id"), *[F.col(c) for c in cols])
    return df.join(stores, F.col("store_id") == F.col("_s_id"), how).drop("_s_id")


def with_mega_region(df: DataFrame, r: Retail) -> DataFrame:
    regions = r.regions_b().select(F.col("region").alias("_pr_region"), "mega_region")
    return df.join(regions, F.col("region") == F.col("_pr_region")).drop("_pr_region")


def sales_lines(r: Retail, start: dt.datetime | None = None, end: dt.datetime | None = None,
                how: str = "inner", interactions: DataFrame | None = None) -> DataFrame:
    """interactions x transaction_items x products x brands.

    ``how='inner'`` is the reference's JOIN chain; ``how='left'`` keeps
    interactions without items (and items without product) as the LEFT JOIN
    chains do. ``line_revenue`` = quantity * unit_price (DECIMAL).
    """
    shared = getattr(r, "shared_lines", None)
    if (shared is not None and interactions is None and how == "inner" and start is not None
            and start >= shared[0] and end is None):
        # A refresh run materialised the inner item join once for the widest
        # window; narrower windows are a filter on it.
        return shared[1].where(F.col("transaction_date") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
    si = interactions if interactions is not None else r.interactions(start, end)
    items = r.transaction_items.select(F.col("interaction_id").alias("_ti_id"), "product_id", "quantity")
    prods = r.product_dim.select(
        F.col("id").alias("_p_id"), F.col("name").alias("product_name"), F.col("category"),
        "is_fmcg", "unit_price", "brand_id", "brand_name", "brand_category")
    lines = (si.join(items, F.col("interaction_id") == F.col("_ti_id"), how)
             .join(prods, F.col("product_id") == F.col("_p_id"), how)
             .drop("_ti_id", "_p_id"))
    return lines.withColumn("line_revenue", (F.col("quantity") * F.col("unit_price")).cast(MONEY))
