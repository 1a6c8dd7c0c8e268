"""Deterministic data-preparation steps of the reference's sample-data load,
re-aimed as operators over the given tables (the random simulators are not
rebuilt; the fixtures replace them)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.sources.retail import Retail

# Store chains by store number within a region
#   1-2 'SM ... Store n' (supermarket, large), 3-4 'Robinson ... Store n-2'
#   (department_store, medium), 5-6 '7-Eleven ... Store n-4'
#   (convenience_store, medium), 7+ 'Sari-Sari Store ... #n-6' (sari_sari, small);
# addresses cycle through eight barangays, in this order:
BARANGAYS = ("Poblacion", "San Antonio", "San Jose", "Santa Cruz", "Barangay 1", "Maligaya", "Riverside", "Centro")


def allocate_by_weight(r: Retail, total: int = 100) -> DataFrame:
    """Per region ceil(total * economic_weight) numbered stores with name,
    address, store type and size class derived from the number."""
    regions = r.ph_regions.select("region", "mega_region",
                                  F.ceil(F.lit(total) * F.col("economic_weight")).cast("int").alias("target_stores"))
    n = F.col("store_num")
    region = F.col("region")
    stores = regions.select("region", "mega_region",
                            F.explode(F.sequence(F.lit(1), F.col("target_stores"))).alias("store_num"))
    name = (F.when(n <= 2, F.concat(F.lit("SM "), region, F.lit(" Store "), n.cast("string")))
            .when(n <= 4, F.concat(F.lit("Robinson "), region, F.lit(" Store "), (n - 2).cast("string")))
            .when(n <= 6, F.concat(F.lit("7-Eleven "), region, F.lit(" Store "), (n - 4).cast("string")))
            .otherwise(F.concat(F.lit("Sari-Sari Store "), region, F.lit(" #"), (n - 6).cast("string"))))
    brgy = F.element_at(F.array(*[F.lit(b) for b in BARANGAYS]), ((n - 1) % 8 + 1).cast("int"))
    return stores.select(
        "region", "mega_region", "store_num", name.alias("store_name"),
        F.concat(F.lit("Brgy. "), brgy, F.lit(", "), region).alias("address"),
        F.when(n <= 2, "supermarket").when(n <= 4, "department_store").when(n <= 6, "convenience_store")
        .otherwise("sari_sari").alias("store_type"),
        F.when(n <= 2, "large").when(n <= 6, "medium").otherwise("small").alias("size_category"))


def backfill_totals(r: Retail) -> DataFrame:
    """total_amount = COALESCE(sum of unit_price * quantity of the basket's
    items, 0). Items are summed per basket first (partial aggregation), then
    joined 1:1 to the baskets."""
    lines = r.transaction_items.join(
        r.products.select(F.col("id").alias("_p"), "unit_price"), F.col("product_id") == F.col("_p"))
    per_basket = (lines.groupBy(F.col("interaction_id").alias("_i"))
                  .agg(F.sum(F.col("unit_price") * F.col("quantity")).alias("_sum")))
    si = r.interactions().select("interaction_id")
    return (si.join(per_basket, F.col("interaction_id") == F.col("_i"), "left")
            .select("interaction_id", F.coalesce(F.col("_sum"), F.lit(0)).cast("decimal(38,2)").alias("total_amount")))


def session_keys(r: Retail) -> DataFrame:
    """transcript / detection keys: prefix + first 12 hex digits of the MD5 of
    the id concatenated with the time (transcript) or the store (detection)."""
    si = r.interactions()
    iid = F.col("interaction_id").cast("string")
    return si.select(
        "interaction_id",
        F.concat(F.lit("transcript-"),
                 F.substring(F.md5(F.concat(iid, F.col("transaction_date").cast("string"))), 1, 12))
        .alias("transcript_id"),
        F.concat(F.lit("detection-"),
                 F.substring(F.md5(F.concat(iid, F.col("store_id").cast("string"))), 1, 12)).alias("detection_id"))


def dim_lookup(facts: DataFrame, dim: DataFrame, name_col: str, dim_name_col: str = "name",
               dim_id_col: str = "id", out_col: str = "brand_id") -> DataFrame:
    """Resolve a name to its dimension id on load (the reference's scalar
    subquery per row) as a LEFT join: unknown names give NULL. The dimension is
    deduplicated on the name first, so the join cannot multiply rows."""
    d = dim.groupBy(F.col(dim_name_col).alias("_dn")).agg(F.min(dim_id_col).alias(out_col))
    return facts.join(d, F.col(name_col) == F.col("_dn"), "left").drop("_dn")
