"""Size-checked broadcast.

``F.broadcast`` is only applied when the optimizer's size estimate of the frame
is below a limit (by default the session's ``autoBroadcastJoinThreshold``).
Above it the frame is returned unchanged and the join stays a shuffle join
(sort-merge, possibly re-planned by AQE from runtime sizes). The estimate is the
same statistic Spark itself uses for automatic broadcast decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DEFAULT_LIMIT = 10 * 1024 * 1024


def _parse_bytes(text: str) -> int:
    text = (text or "").strip().lower()
    units = {"b": 1, "k": 1024, "kb": 1024, "m": 1024**2, "mb": 1024**2, "g": 1024**3, "gb": 1024**3}
    for suffix in sorted(units, key=len, reverse=True):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * units[suffix])
    return int(text)


def broadcast_limit(df: DataFrame) -> int:
    try:
        value = _parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    except Exception:  # pragma: no cover - conf missing or unparsable
        value = _DEFAULT_LIMIT
    return value if value > 0 else 0


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer size estimate in bytes, or None if not available."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes().toString()))
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def size_checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if its estimated size is at most ``max_bytes``."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    size = estimated_size(df)
    if limit > 0 and size is not None and size <= limit:
        return F.broadcast(df)
    return df
