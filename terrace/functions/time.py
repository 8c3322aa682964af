"""Dates and epochs. Every unit is explicit: nothing relies on a bare cast of a number to a timestamp."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_LIMIT = 10_000_000_000  # fixed value: smaller epochs are seconds, larger ones milliseconds


def in_last_days(c: Column, as_of: date, n: int) -> Column:
    """c > as_of - n and c <= as_of, as a plain range on the stored column so that the scan can use it.

    Works on timestamps, dates and yyyy-MM-dd strings alike.
    """
    start, end = as_of - timedelta(days=n - 1), as_of + timedelta(days=1)
    return (c >= F.lit(start.isoformat())) & (c < F.lit(end.isoformat()))


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def second_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def epoch_normalise(c: Column, unit: str = "auto", tz: str | None = None) -> Column:
    """Epoch number or digit string to timestamp. unit: s, ms or auto; garbage becomes null."""
    number = c.try_cast("bigint")
    millis = {
        "s": lambda: number * 1000,
        "ms": lambda: number,
        "auto": lambda: F.when(F.abs(number) < SECONDS_LIMIT, number * 1000).otherwise(number),
    }[unit]()
    stamp = F.timestamp_millis(millis)
    return F.from_utc_timestamp(stamp, tz) if tz else stamp


def epoch_day(c: Column) -> Column:
    """Days since 1970-01-01 to date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), c.try_cast("int"))


def iso_text(c: Column) -> Column:
    """2025-07-13T08:30:00Z to 2025-07-13 08:30:00."""
    return F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))
