from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Exact amounts: cast before summing, so that sums do not depend on the order of the rows."""
    return _col(c).cast(MONEY)


def sum_money(c: str | Column, name: str) -> Column:
    return F.sum(F.coalesce(money(c), F.lit(0).cast(MONEY))).cast("decimal(18,2)").alias(name)


def weighted_avg(num: str | Column, den: str | Column) -> Column:
    """sum / sum, null when the denominator is 0."""
    return F.try_divide(F.sum(_col(num)), F.sum(_col(den)))


def truncated_avg(c: str | Column) -> Column:
    return F.avg(_col(c)).cast("bigint")
