"""Event-time windows. Every function takes a stream or a static frame.

Output rows carry stt and edt (window bounds) and cur_date. Sums are combined before the shuffle, so a hot window or key
does not pull its rows onto one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.measures import sum_money
from terrace.functions.time import second_text
from terrace.streaming.bounded import watermark as _watermark
from terrace.streaming.state import BUCKETS, first_of_day, login_marks


def window_columns(df: DataFrame, window: str = "window") -> DataFrame:
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    rest = [c for c in df.columns if c != window]
    return df.select(second_text(start).alias("stt"), second_text(end).alias("edt"), F.date_format(start, "yyyy-MM-dd").alias("cur_date"), *rest)


def _windowed(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return window_columns(df.groupBy(F.window(ts, size).alias("window"), *keys).agg(*aggs))


def amount_window(df: DataFrame, ts: str, keys: Sequence[str], measures: Mapping[str, str], size: str, watermark: str | None = None) -> DataFrame:
    """Sums per key and window. measures: output -> column. Give no watermark when the input already carries one."""
    rows = _watermark(df, ts, watermark) if watermark else df
    return _windowed(rows, ts, size, keys, [sum_money(c, n) for n, c in measures.items()])


def distinct_window(df: DataFrame, ts: str, keys: Sequence[str], ident: str, amount: str, size: str, watermark: str | None) -> DataFrame:
    """Distinct records and their amount per key and window.

    Two aggregations: first per record, then per window. No set of ids is held for a key, however many there are.
    """
    rows = _watermark(df, ts, watermark) if watermark else df
    per_id = rows.groupBy(F.window(ts, size).alias("window"), *keys, ident).agg(sum_money(amount, "_amount"))
    out = per_id.groupBy(F.window(F.window_time("window"), size).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("_amount").cast("decimal(18,2)").alias("order_amount"))
    return window_columns(out, "w")


def page_view_parts(df: DataFrame, ts: str, visitor: str, dims: Sequence[str], duration: str, last_page: str, delay: str = "1 day", order: Sequence[str] = (),
                    buckets: int = BUCKETS) -> DataFrame:
    """Additive parts of the page-view measures: one row per view, and first views of a visitor's day, given and taken back.

    Only what first views need passes through keyed state, on a branch of the stream that is joined in by union.
    """
    views = _watermark(df, ts, delay).select(ts, *dims, F.lit(0).alias("uv"), F.lit(1).alias("pv"), F.col(last_page).isNull().cast("int").alias("sv"),
                                             F.col(duration).cast("bigint").alias("dur"))
    seen = df.select(*dict.fromkeys([ts, visitor, *dims, *order]))
    firsts = first_of_day(seen, [visitor], ts, delay, order, buckets).select(
        ts, *dims, F.col("delta").alias("uv"), F.lit(0).alias("pv"), F.lit(0).alias("sv"), F.lit(0).cast("bigint").alias("dur"))
    return views.unionByName(firsts)


PAGE_VIEW_SUMS = {"uv_ct": "uv", "sv_ct": "sv", "pv_ct": "pv", "dur_sum": "dur"}


def page_view_window(df: DataFrame, ts: str, visitor: str, dims: Sequence[str], duration: str, last_page: str, size: str, delay: str = "1 day", order: Sequence[str] = (),
                     buckets: int = BUCKETS) -> DataFrame:
    """Views, visitors of the day, sessions opened and stay per dimension and closed window.

    Windows close once the watermark passes, `delay` later. To see them grow at once, write page_view_parts() with
    sinks.additive_log() instead.
    """
    return _windowed(page_view_parts(df, ts, visitor, dims, duration, last_page, delay, order, buckets), ts, size, dims, [F.sum(c).alias(n) for n, c in PAGE_VIEW_SUMS.items()])


def unique_window(df: DataFrame, ts: str, keys: Sequence[str], size: str, delay: str = "1 day", flags: Mapping[str, Column] | None = None,
                  name: str = "uu_ct", order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Keys seen for the first time that day, counted per window; with `flags`, one count per flag.

    A flag's key is unique per day on its own (home page and detail page visitors are separate), so the flag's branch of
    the stream is deduplicated by itself.
    """
    if not flags:
        seen = df.select(*dict.fromkeys([ts, *keys, *order]))
        return _windowed(first_of_day(seen, keys, ts, delay, order, buckets), ts, size, [], [F.sum("delta").alias(name)]).where(F.col(name) != 0)
    which = F.lit(None)
    for label, cond in flags.items():
        which = F.when(cond, F.lit(label)).otherwise(which)
    seen = df.withColumn("_flag", which).where("_flag is not null").select(*dict.fromkeys([ts, *keys, "_flag", *order]))
    firsts = first_of_day(seen, [*keys, "_flag"], ts, delay, order, buckets)
    out = _windowed(firsts, ts, size, [], [F.sum(F.when(F.col("_flag") == label, F.col("delta")).otherwise(0)).alias(label) for label in flags])
    return out.where(" or ".join(f"{label} <> 0" for label in flags))


def login_window(df: DataFrame, ts: str, key: str, size: str, delay: str, back_days: int = 8, order: Sequence[str] = (), ttl: str | None = "400 days", buckets: int = BUCKETS) -> DataFrame:
    """Users logging in for the first time that day, and those of them back after a long gap, per window."""
    marks = login_marks(df, key, ts, delay, back_days, ttl, order, buckets)
    return _windowed(marks, ts, size, [], [F.sum("back").alias("back_ct"), F.sum("uu").alias("uu_ct")]).where("back_ct <> 0 or uu_ct <> 0")


def keyword_counts(df: DataFrame, text: str, ts: str, size: str, watermark: str, pattern: str = r"[^\p{L}\p{N}]+") -> DataFrame:
    """Distinct keywords of each text, counted per window. A tokeniser column can be used by passing words in an array."""
    words = F.col(text) if dict(df.dtypes)[text].startswith("array") else F.split(F.lower(F.col(text)), pattern)
    rows = _watermark(df, ts, watermark).select(ts, F.explode(F.array_distinct(words)).alias("keyword")).where("keyword <> ''")
    return _windowed(rows, ts, size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")])
