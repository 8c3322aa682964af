"""Day, n-day and to-date rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.time import in_last_days


def fan_out_recent_days(df: DataFrame, date_col: str, as_of: date, days: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """One copy of a row per n whose last n days contain it; rows outside every n are cut at the scan.

    Plain comparisons and an explode keep this inside generated code; higher-order functions would leave it.
    """
    fits = [F.when(F.col("_day") > F.lit(as_of - timedelta(days=n)), F.lit(n)) for n in days]
    rows = df.where(in_last_days(F.col(date_col), as_of, max(days))).withColumn("_day", F.to_date(F.col(date_col)))
    return rows.withColumn("recent_days", F.explode(F.array(*fits))).where("recent_days is not null").drop("_day")


def recent_days_rollup(df: DataFrame, date_col: str, as_of: date, days: Sequence[int], keys: Sequence[str],
                       aggs: Sequence[Column]) -> DataFrame:
    """Aggregate the last n days for several n in one pass over the data."""
    return fan_out_recent_days(df, date_col, as_of, days).groupBy("recent_days", *keys).agg(*aggs)


def daily_rollup(df: DataFrame, keys: Sequence[str], date_col: str | None, aggs: Sequence[Column]) -> DataFrame:
    """One row per key and day. `date_col` None groups by the keys alone (a frame that already is one day)."""
    return df.groupBy(*keys, *([date_col] if date_col else [])).agg(*aggs)


def nday_wide(df: DataFrame, date_col: str, as_of: date, keys: Sequence[str], measures: Mapping[str, str],
              days: Sequence[int] = (7, 30)) -> DataFrame:
    """Columns `<output>_<n>d` for every measure and n, by conditional sums in one aggregation."""
    sums = [F.sum(F.when(in_last_days(F.col(date_col), as_of, n), F.col(source)).otherwise(F.lit(0)))
            .alias(f"{output}_{n}d") for n in days for output, source in measures.items()]
    return df.where(in_last_days(F.col(date_col), as_of, max(days))).groupBy(*keys).agg(*sums)


def dedup_then_sum(df: DataFrame, entity: str, value: str, keys: Sequence[str], count_name: str = "order_count",
                   sum_name: str = "order_amount") -> DataFrame:
    """Count entities and add up each entity's value once, however many rows repeat it.

    Both levels aggregate map-side first, so neither a hot entity nor a hot key lands whole on one task.
    """
    once = df.groupBy(entity, *keys).agg(F.max(value).alias("_value"))
    return once.groupBy(*keys).agg(F.count(entity).alias(count_name),
                                   F.sum("_value").cast("decimal(18,2)").alias(sum_name))


def to_date_rebuild(daily: DataFrame, key: str, date_col: str, measures: Sequence[str], first: str = "order_date_first",
                    last: str = "order_date_last") -> DataFrame:
    """First and last day and running totals from the whole history."""
    return daily.groupBy(key).agg(F.min(date_col).alias(first), F.max(date_col).alias(last),
                                  *[F.sum(m).alias(m) for m in measures])


def to_date_merge_outer(old: DataFrame, new: DataFrame, key: str, as_of: date, measures: Sequence[str],
                        first: str = "order_date_first", last: str = "order_date_last") -> DataFrame:
    """Yesterday's totals full-outer-joined with today's. Both sides hold one row per key, so no key is hot."""
    o, n = old.alias("o"), new.alias("n")
    today = F.lit(as_of.isoformat()).cast(old.schema[first].dataType)
    totals = [(F.coalesce(F.col(f"o.{m}"), F.lit(0)) + F.coalesce(F.col(f"n.{m}"), F.lit(0)))
              .cast(old.schema[m].dataType).alias(m) for m in measures]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(
        F.coalesce(f"o.{key}", f"n.{key}").alias(key),
        F.coalesce(F.col(f"o.{first}"), today).alias(first),
        F.when(F.col(f"n.{key}").isNotNull(), today).otherwise(F.col(f"o.{last}")).alias(last), *totals)


def to_date_merge_union(old: DataFrame, new: DataFrame, key: str, as_of: date, measures: Sequence[str],
                        first: str = "order_date_first", last: str = "order_date_last", day: str | None = None) -> DataFrame:
    """The same merge as one union and one aggregation. The new rows may be of several days, which `day` then holds."""
    when = (F.lit(as_of.isoformat()) if day is None else F.col(day)).cast(old.schema[first].dataType)
    both = old.select(key, first, last, *measures).unionByName(
        new.select(key, when.alias(first), when.alias(last), *measures))
    return both.groupBy(key).agg(F.min(first).alias(first), F.max(last).alias(last),
                                 *[F.sum(m).cast(old.schema[m].dataType).alias(m) for m in measures])


def stats_by_dim(sales: DataFrame, keys: Sequence[str], user: str, date_col: str, as_of: date,
                 days: Sequence[int] = (1, 7, 30), count: Column | None = None,
                 extra: Sequence[Column] = ()) -> DataFrame:
    """Orders and distinct buyers per dimension for each n.

    The users of a dimension are counted by collapsing (n, keys, user) first: two aggregations with map-side
    combine, and no multi-way distinct expansion.
    """
    per_user = fan_out_recent_days(sales, date_col, as_of, days).groupBy("recent_days", *keys, user).agg(
        (F.count(F.lit(1)) if count is None else F.sum(count)).alias("_n"), *extra)
    return per_user.groupBy("recent_days", *keys).agg(
        F.sum("_n").alias("order_count"), F.count(F.when(F.col("_n") > 0, F.col(user))).alias("order_user_count"))
