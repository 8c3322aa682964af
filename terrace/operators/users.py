"""User and traffic analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.measures import truncated_avg
from terrace.functions.time import in_last_days
from terrace.operators.rollups import fan_out_recent_days


def channel_stats(sessions: DataFrame, date_col: str, channel: str, device: str, as_of: date,
                  days: Sequence[int] = (1, 7, 30), duration: str = "during_time_1d", pages: str = "page_count_1d",
                  per_second: int = 1000) -> DataFrame:
    """Visitors, mean stay, mean pages, sessions and bounce rate per channel, from one row per session.

    Averages are sums over the sessions and visitors are distinct devices. Collapsing to (n, channel, device) first
    serves all of them with two plain aggregations.
    """
    per_device = fan_out_recent_days(sessions, date_col, as_of, days).groupBy("recent_days", channel, device).agg(
        F.sum(duration).alias("_stay"), F.count(duration).alias("_stays"), F.sum(pages).alias("_pages"),
        F.count(F.lit(1)).alias("_sessions"), F.count_if(F.col(pages) == 1).alias("_bounces"))
    return per_device.groupBy("recent_days", F.col(channel).alias("channel")).agg(
        F.count(device).alias("uv_count"),
        F.try_divide(F.sum("_stay"), F.sum("_stays") * per_second).cast("bigint").alias("avg_duration_sec"),
        F.try_divide(F.sum("_pages"), F.sum("_sessions")).cast("bigint").alias("avg_page_count"),
        F.sum("_sessions").alias("sv_count"),
        F.try_divide(F.sum("_bounces"), F.sum("_sessions")).cast("decimal(16,2)").alias("bounce_rate"))


def session_traffic_stats(events: DataFrame, session: Sequence[str], device: str, channel: Column, duration: str,
                          date_col: str, as_of: date, days: Sequence[int] = (1, 7, 30), per_second: int = 1000) -> DataFrame:
    """Page rows to sessions to channel_stats. `channel` is an aggregate that picks the session's channel."""
    sessions = (events.where(in_last_days(F.col(date_col), as_of, max(days))).groupBy(*session, date_col, device)
                .agg(channel.alias("channel"), F.sum(duration).alias("during_time_1d"),
                     F.count(F.lit(1)).alias("page_count_1d")))
    return channel_stats(sessions, date_col, "channel", device, as_of, days, per_second=per_second)


def page_path(views: DataFrame, session: Sequence[str], page: str, time_col: str, tie: str, piece_seconds: int = 3600) -> DataFrame:
    """Edges `step-n:page` to `step-(n+1):next` with their counts.

    Steps need every session in order. Every session is cut into pieces of `piece_seconds`; a piece is what one task has to sort, and
    the piece totals (one short row each) carry the step offset and the next page across the cuts. Rows without a session are one
    session, rows without a time come first in theirs.
    """
    views = views.select(*session, F.col(page).alias("_page"), F.col(time_col).alias("_t"), F.col(tie).alias("_tie"))
    cut = views.withColumn("_piece", F.coalesce(F.floor(F.unix_seconds("_t") / piece_seconds), F.lit(-(1 << 62))))
    keys = [*session, "_piece"]
    first_page = F.min(F.struct("_t", "_tie", "_page"))["_page"]
    pieces = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), first_page.alias("_first"))
    along = Window.partitionBy(*session).orderBy("_piece")
    pieces = pieces.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(keys)], F.lead("_first").over(along).alias("_after"),
                           (F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                            - F.col("_size")).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy("_t", "_tie", "_page")
    same_piece = F.lit(True)
    for i, k in enumerate(keys):
        same_piece = same_piece & F.col(k).eqNullSafe(F.col(f"_of{i}"))
    steps = (cut.select(*keys, "_page", F.row_number().over(inside).alias("_n"), F.lead("_page").over(inside).alias("_next"))
             .join(pieces, same_piece)
             .select("_page", (F.col("_n") + F.col("_before")).alias("_step"), F.coalesce("_next", "_after").alias("_next")))
    return steps.groupBy(
        F.concat(F.lit("step-"), F.col("_step").cast("string"), F.lit(":"), "_page").alias("source"),
        F.coalesce(F.concat(F.lit("step-"), (F.col("_step") + 1).cast("string"), F.lit(":"), "_next"), F.lit("null"))
        .alias("target")).agg(F.count(F.lit(1)).alias("path_count"))


def churn_and_return(activity: DataFrame, user: str, day: str, as_of: date, churn: int = 7, back: int = 8) -> DataFrame:
    """Users last seen exactly `churn` days ago, and users seen today after a gap of `back` days or more.

    One aggregation per user answers both, so the two scalar reports need no join.
    """
    d = F.to_date(F.col(day))
    per_user = activity.where(d <= F.lit(as_of)).groupBy(user).agg(
        F.max(d).alias("_last"), F.max(F.when(d < F.lit(as_of), d)).alias("_previous"))
    return change_counts(per_user, "_last", "_previous", as_of, churn, back)


def change_counts(profile: DataFrame, last: str, previous: str, as_of: date, churn: int = 7, back: int = 8) -> DataFrame:
    """churn_and_return from to-date profiles: last day as of today and as of yesterday."""
    last_day, prev_day = F.to_date(F.col(last)), F.to_date(F.col(previous))
    return profile.agg(
        F.count_if(last_day == F.lit(as_of - timedelta(days=churn))).alias("user_churn_count"),
        F.count_if((last_day == F.lit(as_of)) & (F.date_diff(F.lit(as_of), prev_day) >= back)).alias("user_back_count"))


def cohort_rates(profile: DataFrame, first: str, last: str, as_of: date, span: int = 7) -> DataFrame:
    """Cohorts of the last `span` days: size, users seen today, rate in percent."""
    f, l = F.to_date(F.col(first)), F.to_date(F.col(last))
    kept = F.count_if(l == F.lit(as_of))
    return (profile.where((f >= F.lit(as_of - timedelta(days=span))) & (f < F.lit(as_of)))
            .groupBy(F.date_format(f, "yyyy-MM-dd").alias("create_date"),
                     F.date_diff(F.lit(as_of), f).alias("retention_day"))
            .agg(kept.alias("retention_count"), F.count(F.lit(1)).alias("new_user_count"),
                 (kept / F.count(F.lit(1)) * 100).cast("decimal(16,2)").alias("retention_rate")))


def first_last_days(activity: DataFrame, user: str, day: str, as_of: date) -> DataFrame:
    d = F.to_date(F.col(day))
    return activity.where(d <= F.lit(as_of)).groupBy(user).agg(F.min(d).alias("_first"), F.max(d).alias("_last"))


def retention_cohorts(activity: DataFrame, user: str, day: str, as_of: date, span: int = 7) -> DataFrame:
    return cohort_rates(first_last_days(activity, user, day, as_of), "_first", "_last", as_of, span)


def new_active_counts(profile: DataFrame, first: str, last: str, as_of: date, days: Sequence[int] = (1, 7, 30)) -> DataFrame:
    cutoff = F.date_sub(F.lit(as_of), F.col("recent_days"))
    return (fan_out_recent_days(profile, last, as_of, days).groupBy("recent_days").agg(
        F.count_if(F.to_date(F.col(first)) > cutoff).alias("new_user_count"),
        F.count(F.lit(1)).alias("active_user_count")))


def new_active_users(activity: DataFrame, user: str, day: str, as_of: date, days: Sequence[int] = (1, 7, 30)) -> DataFrame:
    return new_active_counts(first_last_days(activity, user, day, as_of), "_first", "_last", as_of, days)


def funnel(events: DataFrame, user: str, step_col: str, steps: Mapping[str, str], date_col: str, as_of: date) -> DataFrame:
    """Distinct users per step on one day: one scan, one row. steps: output column -> step value."""
    per_user = (events.where(in_last_days(F.col(date_col), as_of, 1) & F.col(step_col).isin(*steps.values()))
                .groupBy(user).agg(*[F.max((F.col(step_col) == v).cast("int")).alias(k) for k, v in steps.items()]))
    return per_user.agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("bigint").alias(k) for k in steps])


def new_order_users(orders: DataFrame, user: str, day: str, as_of: date, days: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """Users whose first order lies in the last n days."""
    first = orders.where(F.to_date(F.col(day)) <= F.lit(as_of)).groupBy(user).agg(F.min(F.to_date(F.col(day))).alias("_first"))
    return fan_out_recent_days(first, "_first", as_of, days).groupBy("recent_days").agg(
        F.count(F.lit(1)).alias("new_order_user_count"))


def consecutive_days(activity: DataFrame, user: str, day: str, as_of: date, run: int = 3, span: int = 7,
                     method: str = "mask") -> DataFrame:
    """Users active on `run` days in a row within the last `span` days.

    mask: one bit per day, or-ed per user, no sort; the default. lead and island: window forms over distinct days
    (at most `span` rows a user); all three agree. loose: `run` active days within run + 1.
    """
    recent = activity.where(in_last_days(F.col(day), as_of, span)).select(user, F.to_date(F.col(day)).alias("_day"))
    name = "order_continuously_user_count"
    if method == "mask":
        bits = recent.groupBy(user).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.date_diff(F.lit(as_of), "_day"))).alias("_bits"))
        streak = F.col("_bits")
        for step in range(1, run):
            streak = streak.bitwiseAND(F.shiftright(F.col("_bits"), step))
        return bits.agg(F.count_if(streak != 0).alias(name))
    days = recent.distinct()
    ordered = Window.partitionBy(user).orderBy("_day")
    if method == "island":
        islands = days.withColumn("_island", F.date_sub("_day", F.rank().over(ordered)))
        users = islands.groupBy(user, "_island").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= run)
    else:
        reach = {"lead": run - 1, "loose": run}[method]
        ahead = F.date_diff(F.lead("_day", run - 1).over(ordered), "_day")
        users = days.withColumn("_ahead", ahead).where(F.col("_ahead") <= reach)
    return users.select(user).distinct().agg(F.count(F.lit(1)).alias(name))


def repeat_rate(per_user: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Users with two or more orders / users with one or more, from one row per user and key."""
    return per_user.groupBy(*keys).agg(
        F.try_divide(F.count_if(F.col(count) >= 2), F.count_if(F.col(count) >= 1)).cast("decimal(16,2)")
        .alias("order_repeat_rate"))


def repeat_purchase_rate(sales: DataFrame, user: str, keys: Sequence[str], day: str, as_of: date, span: int = 30) -> DataFrame:
    per_user = (sales.where(in_last_days(F.col(day), as_of, span)).groupBy(user, *keys)
                .agg(F.count(F.lit(1)).alias("_orders")))
    return repeat_rate(per_user, keys, "_orders")
