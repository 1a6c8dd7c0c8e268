"""Connected components of a link table, on Spark.

Alternating large-star and small-star steps: every node's larger neighbours (then
its smaller ones) are re-attached to the smallest node seen, until each node
points at the smallest node of its component. Each step is two shuffles on the
node; a hub is a skewed join side that AQE splits, never a collected group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    at = e.join(low, "u")
    return at.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                     F.col("m").alias("v")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Links to null or to itself count as none; repeated links and either direction are fine.
    """
    e = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u > v").distinct(), "links")
    seen = None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        e = stored(_small_star(_large_star(e)), "stars")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
