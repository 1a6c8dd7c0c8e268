"""Shared pieces of the training-data operators: tables, stored steps, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import scratch_path

#: Rows in one Arrow batch of texts; long documents must not make a batch of gigabytes.
TEXT_BATCH_ROWS = 1000

#: Ids that may be broadcast as one set of keys (16 bytes each in Spark's hash relation: 32 MB).
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size to TEXT_BATCH_ROWS where the session has a larger one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage and survives lost executors; later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_filter(df: DataFrame, ids: DataFrame, key: str, n_ids: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (distinct, ``n_ids`` rows).

    The ids are broadcast only up to BROADCAST_IDS; beyond, a shuffle join does it.
    """
    if n_ids <= BROADCAST_IDS:
        return df.join(F.broadcast(ids), key, "left_semi")
    return df.join(ids.hint("shuffle_hash"), key, "left_semi")
