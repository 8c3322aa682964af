"""Joins between streams and with dimension tables.

Stream-stream joins carry watermarks and a time range on both sides, so their state is bounded. Dimension tables are
static frames; Spark broadcasts them when they are below its size threshold.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(left: Column, right: Column, lo: str, hi: str) -> Column:
    """right + lo <= left <= right + hi, with interval texts such as '-30 minutes'."""
    return (left >= right + F.expr(f"INTERVAL {lo}")) & (left <= right + F.expr(f"INTERVAL {hi}"))


def _renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in columns.items()])


def interval_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_time: str, right_time: str, lo: str, hi: str,
                  how: str = "inner") -> DataFrame:
    """left joined to right where the keys match and left_time lies in [right_time + lo, right_time + hi]."""
    cond = within(F.col(left_time), F.col(right_time), lo, hi)
    for l, r in on.items():
        cond = cond & (F.col(l) == F.col(r))
    return left.join(right, cond, how)


def interval_merge(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_time: str, right_time: str, lo: str, hi: str,
                   prefix: str = "info_") -> DataFrame:
    """interval_join whose right columns all get a prefix."""
    side = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    return interval_join(left, side, {l: prefix + r for l, r in on.items()}, left_time, prefix + right_time, lo, hi)


def order_detail_stream(detail: DataFrame, header: DataFrame, activity: DataFrame, coupon: DataFrame, lo: str, hi: str,
                        side_lo: str, side_hi: str, late: Mapping[str, int] | None = None) -> DataFrame:
    """Detail rows with header (inner; within lo..hi), activity and coupon (left outer; within side_lo..side_hi of them).

    Columns: detail(id, order_id, detail_time, ..), header(header_id, header_time, ..), activity(act_detail_id, act_time, ..),
    coupon(cou_detail_id, cou_time, ..). Unmatched details leave the outer joins once the watermark passes their range. `late` has the days by which
    header_time, act_time and cou_time have been moved (bounded.moved), as a replay lets them come before (below 0) or after the details.
    """
    late = late or {}

    def ranges(time: str, *texts: str) -> list[str]:
        return [f"{x} {-late.get(time, 0)} days" for x in texts]
    # Only one event time may go on after each join: the detail's. Rows on the right are not kept if all their partners have come, so details are there.
    met = within(F.col("detail_time"), F.col("header_time"), *ranges("header_time", lo, hi)) & (F.col("order_id") == F.col("header_id"))
    rows = header.join(detail, met).select(*detail.columns, *(c for c in header.columns if c != "header_time"))
    rows = interval_join(rows, activity, {"id": "act_detail_id"}, "detail_time", "act_time", *ranges("act_time", side_lo, side_hi), "leftOuter").drop("act_time")
    return interval_join(rows, coupon, {"id": "cou_detail_id"}, "detail_time", "cou_time", *ranges("cou_time", side_lo, side_hi), "leftOuter").drop("cou_time")


def cancel_stream(detail: DataFrame, orders: DataFrame, status: str, cancelled: Sequence[str], lo: str, hi: str) -> DataFrame:
    """Detail rows of orders that reached a cancelled status."""
    return interval_join(detail, orders.where(F.col(status).isin(*cancelled)), {"order_id": "header_id"}, "detail_time", "header_time", lo, hi)


def lookup(df: DataFrame, dim: DataFrame, on: tuple[str, str], columns: Mapping[str, str], default: str | None = None, how: str = "left") -> DataFrame:
    """Add dimension columns. A miss gives null or `default`, or drops the row when how is "inner"."""
    side = dim.select(F.col(on[1]).cast("string").alias("_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    out = df.join(side, F.col(on[0]).cast("string") == F.col("_key"), how).drop("_key")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(default)) for n in columns.values()}) if default is not None else out


def enrich_chain(df: DataFrame, steps: Sequence[tuple[DataFrame, tuple[str, str], Mapping[str, str]]], default: str | None = None, how: str = "left") -> DataFrame:
    """Lookups one after the other; a step may use a column that an earlier one brought in."""
    for dim, on, columns in steps:
        df = lookup(df, dim, on, columns, default, how)
    return df


def refund_stream(refund: DataFrame, orders: DataFrame, lo: str, hi: str, lookups: Sequence[tuple[DataFrame, tuple[str, str], Mapping[str, str]]]) -> DataFrame:
    """Refund rows with the order's columns and decoded refund type and reason."""
    return enrich_chain(interval_join(refund, orders, {"order_id": "header_id"}, "refund_time", "header_time", lo, hi), lookups)


def refund_paid_stream(pay: DataFrame, refund: DataFrame, orders: DataFrame, lo: str, hi: str,
                       lookups: Sequence[tuple[DataFrame, tuple[str, str], Mapping[str, str]]]) -> DataFrame:
    """Refund payments with the refund (two keys), the order and the payment dictionary."""
    rows = interval_join(pay, refund, {"order_id": "refund_order_id", "sku_id": "refund_sku_id"}, "pay_time", "refund_time", lo, hi).drop("refund_time")
    rows = interval_join(rows, orders, {"order_id": "header_id"}, "pay_time", "header_time", lo, hi).drop("header_time")
    return enrich_chain(rows, lookups)


def refreshed(read: Callable[[], DataFrame], max_age: float = 0) -> Callable[[], DataFrame]:
    """A dimension that follows its changes: called for each micro-batch (run_to_end's `each`), it is read again when what it holds is older than
    `max_age` seconds. A frame in a streaming plan is read once for the life of the query."""
    held: list = []

    def frame() -> DataFrame:
        now = time.monotonic()
        if not held or now - held[1] >= max_age:
            held[:] = [read(), now]
        return held[0]
    return frame
