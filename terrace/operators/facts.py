"""Fact building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.writers import OPEN_DATE


def avg_interval_seconds(df: DataFrame, start: str, end: str, keys: Sequence[str] = (), name: str = "interval_avg") -> DataFrame:
    """Mean seconds from one time to another, truncated; rows without an end do not count."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return df.where(F.col(end).isNotNull()).groupBy(*keys).agg(F.avg(seconds).cast("bigint").alias(name))


def accumulating_snapshot(open_rows: DataFrame, new_rows: DataFrame, milestones: Sequence[tuple[DataFrame, Mapping[str, str]]],
                          key: str, close_on: str) -> DataFrame:
    """Fill milestone columns of open and new rows; dt is the closing day, or 9999-12-31 while open.

    milestones: (frame with one row per key, column of the frame -> column of the snapshot). A milestone that is
    already set is kept.
    """
    rows = open_rows.unionByName(new_rows, allowMissingColumns=True)
    for i, (frame, columns) in enumerate(milestones):
        side = frame.select(F.col(key).alias(f"_k{i}"), *[F.col(c).alias(f"_m{i}_{n}") for c, n in columns.items()])
        rows = rows.join(side, F.col(key) == F.col(f"_k{i}"), "left")
        rows = rows.withColumns({n: F.coalesce(F.col(n), F.col(f"_m{i}_{n}")) for n in columns.values()})
        rows = rows.drop(f"_k{i}", *[f"_m{i}_{n}" for n in columns.values()])
    return rows.withColumn("dt", F.coalesce(F.substring(F.col(close_on).cast("string"), 1, 10), F.lit(OPEN_DATE)))


def parse_event_json(df: DataFrame, column: str, schema: str | T.StructType, into: str = "doc") -> DataFrame:
    """JSON text to a typed struct, parsed once per row."""
    return df.withColumn(into, F.from_json(F.col(column), schema))


def first_per_group(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group. A minimum over structs combines map-side; nothing is sorted, no group is gathered."""
    rest = [c for c in df.columns if c not in part and c not in order]
    first = F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_first")
    return df.groupBy(*part).agg(first).select(*part, "_first.*").select(*df.columns)


def register_enrich(users: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Registrations with what the registration page view tells about device and channel."""
    return users.join(log, key, "left")


def detail_enrich(detail: DataFrame, *sides: tuple[DataFrame, str, str, Mapping[str, str], str]) -> DataFrame:
    """Detail rows with columns of header and side tables: (frame, detail key, side key, column -> name, join kind)."""
    out = detail
    for i, (frame, left_key, right_key, columns, how) in enumerate(sides):
        side = frame.select(F.col(right_key).alias(f"_k{i}"), *[F.col(c).alias(n) for c, n in columns.items()])
        out = out.join(side, F.col(left_key) == F.col(f"_k{i}"), how).drop(f"_k{i}")
    return out


def snapshot_filter(df: DataFrame, predicate: Column, as_of: str) -> DataFrame:
    """Periodic snapshot: the rows that satisfy the predicate, stamped with the snapshot day."""
    return df.where(predicate).withColumn("dt", F.lit(as_of))


def lifecycle_facts(df: DataFrame, status: str, allow: Sequence[str] | None = None, deny: Sequence[str] | None = None) -> DataFrame:
    """Rows whose status says that a step of the life cycle has been reached."""
    if (allow is None) == (deny is None):
        raise ValueError("give either allow or deny")
    return df.where(F.col(status).isin(*allow) if allow is not None else ~F.col(status).isin(*deny))
