"""Bounded inputs: a closing record that moves every watermark past the end.

A stream over an unbounded source keeps its newest windows open. When the input is known to end, a last record far in the future closes
them: windows still open, unmatched rows of outer joins and timers all come out. A watermark moves after the micro-batch that brought its record, and what
one operator lets go reaches the next one after that has looked at its own state, so a second and a third record follow for chains of two. Operators set their watermarks with watermark(), which
inside `bounded` also listens to a folder; run_to_end() writes the closing record there once everything else has been processed.

Tables too large for one micro-batch come as a change topic brings them, in the order of their times: replayed() deals them into slices of whole days, and
run_to_end() hands over one slice after the other. Watermarks then move along with the rows, so that joins keep what lies within their ranges and no more.
A table may come some days before or after the others. Where the side of a join with fewer rows comes first, by more than the range and a slice, the rows of the
other side are not kept at all: the watermark says that all their partners have come. The times that watermarks follow are moved by the same days (moved()).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import work_dir

#: Event times of the closing records; rows of the input must be earlier.
CLOSING = ("9000-01-01 00:00:00", "9001-01-01 00:00:00", "9002-01-01 00:00:00")
#: Rows in a slice of a replay, if its days have no more.
SLICE_ROWS = 10_000_000


class Input:
    """An input that ends; one run over it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.heard = spark, f"{work_dir(spark)}/closing-{uuid.uuid4().hex}", False
        self.topic: DataFrame | None = None
        self.waiting: tuple[str, int] = ("", 0)

    def listen(self, fields: Sequence[T.StructField] = ()) -> DataFrame:
        """Closing records, with nulls in more columns. These are missing in the files and no literals, as the optimizer would take a micro-batch of closing
        records alone for one where a join's keys are null, and drop the other side's rows."""
        if not self.heard:
            self._write(None)
            self.heard = True
        schema = T.StructType([T.StructField("_closing", T.TimestampType()), *(T.StructField(f.name, f.dataType) for f in fields)])
        closing = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.folder)
        if self.topic is None:
            return closing
        return closing.unionByName(self.topic.where(F.col("_table") == "").select("_closing"), allowMissingColumns=True)

    def replayed(self, tables: Mapping[str, tuple[DataFrame, str]], lags: Callable[[int], Mapping[str, int]] = lambda width: {}) -> tuple[dict[str, DataFrame], Mapping[str, int]]:
        """Stored tables, each with its time column, as streams that run_to_end() feeds in slices, and the days by which each comes late; none of both where one
        slice holds all rows. `lags` says these for slices of so many days. Rows without a time come last."""
        if sum(df.count() for df, _ in tables.values()) <= SLICE_ROWS:
            return {}, {}
        counts = reduce(DataFrame.unionAll, (df.groupBy(_day(ts).alias("day")).count().select(F.lit(name).alias("name"), "day", "count") for name, (df, ts) in tables.items()))
        found = [tuple(row) for row in counts.where("day is not null").collect()]
        if not found:
            return {}, {}

        def in_order(late: Mapping[str, int]) -> list[tuple[int, int]]:
            days: Counter[int] = Counter()
            for name, day, n in found:
                days[day + late.get(name, 0)] += n
            return sorted(days.items())
        days = in_order({})
        first = [days[0][0], *slice_bounds(days, SLICE_ROWS), days[-1][0] + 1]
        width = sorted(b - a for a, b in zip(first, first[1:], strict=False))[(len(first) - 1) // 2]
        late = lags(width)
        bounds = slice_bounds(in_order(late), SLICE_ROWS, width)
        # One source for all, so that a slice is one micro-batch. Each ends with a record that moves all watermarks to its end, also of a table without rows in it.
        base = f"{work_dir(self.spark)}/replay-{uuid.uuid4().hex}"
        names = {name: [f"{name}_{c}" for c in df.columns] for name, (df, _) in tables.items()}
        fields = [T.StructField(n, f.dataType) for name, (df, _) in tables.items() for n, f in zip(names[name], df.schema.fields, strict=True)]
        parts = [df.select(F.lit(name).alias("_table"), *(F.col(c).alias(n) for c, n in zip(df.columns, names[name], strict=True)),
                           _slice(_day(ts) + late.get(name, 0), range(len(bounds) + 1), bounds).alias("_slice")) for name, (df, ts) in tables.items()]
        ends = [(i, day * 86400) for i, day in enumerate(bounds)]
        if ends:
            parts.append(self.spark.createDataFrame(ends, "_slice int, at long").coalesce(1).select("_slice", F.lit("").alias("_table"), F.timestamp_seconds("at").alias("_closing")))
        for part in parts:
            part.write.mode("append").partitionBy("_slice").parquet(f"{base}/waiting")
        schema = T.StructType([T.StructField("_table", T.StringType()), T.StructField("_closing", T.TimestampType()), *fields])
        self.topic, self.waiting = self.spark.readStream.schema(schema).parquet(f"{base}/topic/slice=*"), (base, len(bounds) + 1)
        return {name: self.topic.where(F.col("_table") == name).select(*(F.col(n).alias(c) for c, n in zip(df.columns, names[name], strict=True)))
                for name, (df, _) in tables.items()}, late

    def slices(self) -> Iterator[int]:
        """Hand over one slice of a replay after the other; each has to be processed before the next one, and is then removed."""
        base, n = self.waiting
        for i in range(n):
            fs, at = self._fs(f"{base}/waiting/_slice={i}")
            to = self._fs(f"{base}/topic/slice={i}")[1]
            fs.mkdirs(to.getParent())
            if not fs.rename(at, to):
                raise OSError(f"{at} could not be handed over")
            yield i
            fs.delete(to, True)
            # Micro-batches leave their shuffled rows until the driver's collector finds that nothing refers to them.
            self.spark._jvm.System.gc()

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def closings(self) -> Iterator[str]:
        """Write one closing record after the other; each has to be processed before the next one."""
        for ts in CLOSING:
            self._write(F.lit(ts).cast("timestamp"))
            yield ts

    def _write(self, ts: Column | None) -> None:
        rows = self.spark.range(0, int(ts is not None), 1, 1)
        rows.select((F.lit(None).cast("timestamp") if ts is None else ts).alias("_closing")).write.mode("append").parquet(self.folder)


def _day(ts: str) -> Column:
    return F.unix_date(F.to_date(ts))


def slice_bounds(days: Sequence[tuple[int, int]], rows: int, width: int | None = None) -> list[int]:
    """First days of all slices but the first, where (day, rows) are in order: a slice is closed before the day that would take it over `rows` rows or `width` days."""
    bounds, held, start = [], 0, days[0][0] if days else 0
    for day, n in days:
        if held and (held + n > rows or (width and day - start >= width)):
            bounds.append(day)
            held, start = 0, day
        held += n
    return bounds


def _slice(day: Column, numbers: range, bounds: Sequence[int]) -> Column:
    """The slice of a day by halving. A null goes into the last one."""
    if not bounds:
        return F.lit(numbers[0])
    mid = len(bounds) // 2
    return F.when(day < bounds[mid], _slice(day, numbers[:mid + 1], bounds[:mid])).otherwise(_slice(day, numbers[mid + 1:], bounds[mid + 1:]))


_INPUT: ContextVar[Input | None] = ContextVar("input", default=None)


@contextmanager
def bounded(spark: SparkSession) -> Iterator[Input]:
    """Streams built and run in this context have an input that ends. One run_to_end() belongs to a context."""
    token = _INPUT.set(Input(spark))
    try:
        yield _INPUT.get()
    finally:
        _INPUT.reset(token)


def current() -> Input | None:
    return _INPUT.get()


def watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """df.withWatermark, which for a bounded input ends with the closing record. Rows without a time stay."""
    source = _INPUT.get()
    if source is None or not df.isStreaming:
        return df.withWatermark(ts, delay)
    # A closing record, or one that a slice has ended, has only a time. A condition that is not deterministic keeps the optimizer from moving it or
    # later ones below the watermark, where they would drop the record before it has been seen.
    marks = source.listen([f for f in df.schema.fields if f.name != ts]).withColumn("_mark", F.col("_closing").isNotNull()).withColumnRenamed("_closing", ts)
    both = df.withColumn("_mark", F.lit(False)).unionByName(marks).withWatermark(ts, delay)
    return both.where((F.col(ts).isNull() | (F.col(ts) < F.lit(CLOSING[0]).cast("timestamp"))) & F.when(F.spark_partition_id() >= 0, ~F.col("_mark"))).drop("_mark")


def moved(df: DataFrame, ts: str, days: int) -> DataFrame:
    """df with a time that is so many days later."""
    return df.withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {days} days")) if days else df
