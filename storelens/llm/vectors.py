"""Vectors as numpy blocks, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null or empty, and all its components are finite and not all zero."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of usable rows with an id, as long and array of double."""
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & usable(F.col("vector"))))


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column, all of one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
