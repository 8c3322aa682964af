"""Top-k per group, ties kept, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in an order, for ad-hoc loads."""
    return df.orderBy(*order).limit(n)


def topk_with_ties(df: DataFrame, part: Sequence[str], value: str, k: int, rank_name: str = "rk") -> DataFrame:
    """Rows whose rank() by descending `value` within `part` is at most k.

    A group may hold a large share of all rows and may be all ties, so its rows are never gathered. A row number
    limit, which Spark applies before the shuffle too (WindowGroupLimit), leaves k rows per group; their values and
    ranks are exact, as a row of rank <= k has fewer than k larger ones. The ranks are joined back by group and value, so
    the value has to be of an exact type: a floating sum may differ between two runs of its input.
    """
    if df.schema[value].dataType.typeName() in ("float", "double"):
        raise TypeError(f"{value} is a floating number; cast or round it to a decimal first")
    ordered = Window.partitionBy(*part).orderBy(F.col(value).desc())
    kept = df.select(*part, value).withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= k)
    ranks = (kept.withColumn(rank_name, F.rank().over(ordered)).where(F.col(rank_name) <= k)
             .select(*part, value, rank_name).distinct())
    left, right = df.alias("l"), ranks.alias("r")
    on: Column = F.lit(True)
    for c in (*part, value):
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, on).select("l.*", F.col(f"r.{rank_name}"))
