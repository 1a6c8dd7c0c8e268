"""One-row aggregates as scalar subqueries.

The reference keeps statistics (a mean, a threshold, yesterday's revenue) in
PL/pgSQL variables or scalar subqueries. Here a one-row aggregate becomes a
scalar subquery (``DataFrame.scalar``) returning a struct of its columns: Spark
runs it once, reuses the result wherever it is referenced, and injects it as a
value — no join, and nothing is pulled through the driver by our code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(frame: DataFrame) -> Column:
    """Struct-valued scalar subquery over a one-row frame (NULL if empty)."""
    return frame.select(F.struct(*[F.col(c) for c in frame.columns]).alias("_row")).scalar()


def with_scalars(base: DataFrame, *frames: DataFrame) -> DataFrame:
    """``base`` with every column of each one-row ``frames`` attached."""
    cols = [F.col(c) for c in base.columns]
    for frame in frames:
        row = one_row(frame)
        cols += [row.getField(c).alias(c) for c in frame.columns]
    return base.select(*cols)
