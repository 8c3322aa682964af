"""Combining report frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metrics_full_outer(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer combination of any number of metric frames, each with at most one row per key.

    Computed as one union and one aggregation, so a key present in only some frames gives exactly one row (also a
    null key) and there is a single shuffle however many frames there are.
    """
    names = [c for f in frames for c in f.columns if c not in keys]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    return rows.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def in_flight_balance(opened: DataFrame, closed: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Opened minus closed, by a signed union."""
    signed = opened.select(*keys, *measures).unionByName(closed.select(*keys, *[(-F.col(m)).alias(m) for m in measures]))
    return signed.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def split_attribution(df: DataFrame, owners: Sequence[Column], owner_name: str, shared: Sequence[str],
                      keep: Sequence[str]) -> DataFrame:
    """One row per owner. `shared` measures are divided evenly among the owners, `keep` columns are not.

    A row without any owner stays whole, under a null owner."""
    present = F.filter(F.array(*owners), lambda o: o.isNotNull())
    rows = df.withColumn("_owners", present).withColumn("_count", F.greatest(F.size("_owners"), F.lit(1)))
    halves = [(F.col(m) / F.col("_count")).alias(m) for m in shared]
    return rows.select(F.explode_outer("_owners").alias(owner_name), *halves, *keep)


def missing_rows(new: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of `new` that `history` does not hold; nulls compare equal."""
    n, h = new.alias("n"), history.select(*new.columns).alias("h")
    on = F.lit(True)
    for c in new.columns:
        on = on & F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}"))
    return n.join(h, on, "left_anti")


def union_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """History and new report rows without repeats; applying it twice is a no-op."""
    return history.unionByName(new).distinct()
