"""Differences of two snapshots by a hash tree: only key ranges that differ are joined.

Keys fall into leaves by hash, a fixed number of leaves into a branch. A leaf's digest is
the number of its rows, and the sum and the exclusive or of two 64-bit hashes of each row
(null-safe, over all columns); a branch's digest sums its leaves'. Branches are compared
first, leaves only where branches differ, rows only of leaves that differ: what did not
change is aggregated where it is read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.plans.materialize import materialize

#: Leaves of the tree and of a branch. 65,536 leaves of a table of 10^10 rows have some 150,000 rows each.
LEAVES, BRANCH = 4096, 64


def leaf_of(key: str, leaves: int = LEAVES) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(leaves)).cast("int")


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    values = [x for c in columns for x in (F.col(c), F.col(c).isNull())]  # a null is no missing value
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def leaf_digests(df: DataFrame, key: str, leaves: int = LEAVES, columns: list[str] | None = None) -> DataFrame:
    """(leaf, n, total, mixed): at most ``leaves`` rows, to be stored beside a snapshot. Map columns have no hash."""
    one, two = _row_hashes(columns or sorted(df.columns))
    return (df.groupBy(leaf_of(key, leaves).alias("leaf"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("total"), F.bit_xor(two).alias("mixed")))


def _differing(old: DataFrame, new: DataFrame, by: Column) -> DataFrame:
    """The groups of leaves whose summed digests differ or that only one side has."""
    def summed(digests: DataFrame, side: str) -> DataFrame:
        return (digests.groupBy(by.alias("at")).agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                                                    F.bit_xor("mixed").alias("mixed"))
                .select("at", F.struct("n", "total", "mixed").alias(side)))

    both = summed(old, "old").join(summed(new, "new"), "at", "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("at")


def changed_leaves(old: DataFrame, new: DataFrame, branch: int = BRANCH) -> DataFrame:
    """(leaf) of two digest tables that differ: branches first, then the leaves of differing branches."""
    of_branch = F.floor(F.col("leaf") / branch).cast("int")
    branches = F.broadcast(_differing(old, new, of_branch))  # as many rows as there are branches, at most
    inside = [d.join(branches, of_branch == F.col("at"), "left_semi") for d in (old, new)]
    return _differing(*inside, F.col("leaf")).withColumnRenamed("at", "leaf")


def differing(old: DataFrame, new: DataFrame, key: str, leaves: int = LEAVES, old_digests: DataFrame | None = None,
              new_digests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both snapshots reduced to the leaves that differ: any diff by ``key`` of the two gives the same rows as before.

    ``new`` decides which columns count (others of ``old`` are ignored, as a diff by columns of ``new`` does). Stored
    digests of a side spare its first scan. Null keys are a leaf like any other; repeated keys count as often as they
    stand there. Two empty snapshots give two empty ones.
    """
    columns = sorted(new.columns)
    if set(columns) - set(old.columns):  # new columns: every row may differ
        return old, new
    types = dict(new.dtypes)
    alike = old.select(*[F.col(c).cast(types[c]).alias(c) for c in old.columns if c in types])
    found = materialize(changed_leaves(leaf_digests(alike, key, leaves, columns) if old_digests is None else old_digests,
                                       leaf_digests(new, key, leaves, columns) if new_digests is None else new_digests), "leaves")
    keep = F.broadcast(found.withColumnRenamed("leaf", "_leaf"))  # at most ``leaves`` numbers
    cut = lambda df: df.join(keep, leaf_of(key, leaves) == F.col("_leaf"), "left_semi")
    return cut(old.withColumn(key, F.col(key).cast(types[key]))), cut(new)
