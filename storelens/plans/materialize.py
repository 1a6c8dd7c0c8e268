"""Materialising an intermediate result once.

A frame that is used twice in one plan (e.g. per-product rows and their grand
total) is otherwise recomputed from the scans: Spark only reuses an exchange
when both branches are identical, and column pruning usually makes them
differ. ``materialize`` writes it as parquet into the shared folder named by
``spark.checkpoint.dir`` and reads it back: it survives executor loss and cuts the
lineage, and every later branch reads only its columns and row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from storelens.session import scratch_path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
