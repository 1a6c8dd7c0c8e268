"""Column-level helpers shared by every operator.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen. Number rules (kept identical in the SQL oracles):

* money is DECIMAL: line and basket amounts DECIMAL(18,2), sums DECIMAL(38,2);
  sums of decimals are exact and independent of partition order.
* counts and ranks are BIGINT.
* ratios and averages are DOUBLE, rounded once, last, by ``fixed``: the value is
  cast to DECIMAL(38, k+3) and then rounded half-up to k places. Rounding
  through a decimal makes the result independent of how an engine prints or
  scales doubles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """SUM of a decimal amount, widened so it cannot overflow at scale."""
    return F.sum(col(c)).cast(MONEY_SUM)


def fixed(c: str | Column, k: int = 2) -> Column:
    """Round a DOUBLE (or decimal) half-up to k places, returned as DOUBLE."""
    return F.round(col(c).cast(DecimalType(38, k + 3)), k).cast("double")


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def ratio(num: str | Column, den: str | Column, scale: float = 1.0, k: int = 2) -> Column:
    """``num / NULLIF(den, 0) * scale`` rounded to k places; NULL when den is 0/NULL."""
    d = as_double(den)
    value = as_double(num) / F.when(d != 0, d) * F.lit(float(scale))
    return fixed(value, k)


def pct(num: str | Column, den: str | Column, k: int = 2) -> Column:
    return ratio(num, den, 100.0, k)


def avg_money(c: str | Column, k: int = 6) -> Column:
    """AVG of a decimal amount (exact decimal average, then ``fixed``)."""
    return fixed(F.avg(col(c)), k)


def avg_num(c: str | Column, k: int = 6) -> Column:
    return fixed(F.avg(col(c)), k)


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as BIGINT (NULL cond counts 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1))).cast("long")


def count_distinct(*cols: str | Column) -> Column:
    return F.count_distinct(*[col(c) for c in cols]).cast("long")


def dow(ts: str | Column) -> Column:
    """Day of week with 0 = Sunday (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(col(ts)) - 1).cast("long")


def hour(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("long")


def midnight(value: dt.date | dt.datetime) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    return dt.datetime.combine(value, dt.time())


def ts_lit(value: dt.date | dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal (wall-clock, no time-zone shift; folds to a constant
    so comparisons with a stored column are pushed into the scan)."""
    return F.lit(midnight(value).isoformat(sep=" ")).cast("timestamp_ntz")


def whole_days(later: str | Column, earlier: str | Column) -> Column:
    """EXTRACT(DAY FROM later - earlier): whole 24-hour days (46 h -> 1)."""
    seconds = col(later).cast("timestamp").cast("long") - col(earlier).cast("timestamp").cast("long")
    return F.floor(seconds / F.lit(86400)).cast("long")


def tier(value: Column, cuts: list[tuple[float, str]], default: str, strict: bool = False) -> Column:
    """First-match CASE over descending cut-offs: value >= cut (or > cut)."""
    expr = None
    for cut, label in cuts:
        cond = value > F.lit(cut) if strict else value >= F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def rank_desc(order_col: str | Column, partition: list[str] | None = None) -> Column:
    """RANK() by descending value. Without ``partition`` the window spans all
    rows, so it is only applied to aggregated frames whose size is bounded by a
    dimension (brands, categories, regions), never to fact rows."""
    from pyspark.sql import Window

    w = Window.orderBy(col(order_col).desc())
    if partition:
        w = Window.partitionBy(*partition).orderBy(col(order_col).desc())
    return F.rank().over(w).cast("long")
