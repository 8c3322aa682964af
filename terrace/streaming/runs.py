"""Running streams: named jobs that go on from their checkpoint, and runs over everything that is available."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from terrace.session import setting, tune, work_dir
from terrace.streaming.bounded import current
from terrace.streaming.sinks import KeyedTable, batch_log, read_log

Write = Callable[[DataFrame, int], None]

BOUNDED_SETTINGS = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # Nobody goes back to older micro-batches, and counting all rows of a store looks each key up once more.
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
#: Where many micro-batches change a part of the state each, they write what has changed.
SLICED_SETTINGS = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


class LateRows(StreamingQueryListener):
    """Rows that came behind the watermark and were dropped, per run and stateful operator, counted over the whole run."""

    def __init__(self):
        self.dropped: dict[str, dict[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:
        counts = self.dropped.setdefault(str(event.progress.runId), {})
        for i, operator in enumerate(event.progress.stateOperators):
            counts[i] = counts.get(i, 0) + operator.numRowsDroppedByWatermark

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return sum(self.dropped.get(str(query.runId), {}).values())


def watch_late_rows(spark: SparkSession) -> LateRows:
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query have dropped as too late, as far as its progress reports reach back."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])


def start_job(df: DataFrame, name: str, root: str, write: Write | None = None, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Start a job that goes on from where it stopped: its checkpoint lies under its name, and a repeated micro-batch replaces itself.

    `every` is the trigger interval ("30 seconds"); without it the job takes what is available and ends. `write` is a foreachBatch
    writer; by default rows go to `root`/`name`/rows, a folder per micro-batch.
    """
    tune(df.sparkSession)
    base = f"{root.rstrip('/')}/{name}"
    writer = df.writeStream.queryName(f"{name}-{uuid.uuid4().hex[:8]}").foreachBatch(write or batch_log(f"{base}/rows")).outputMode(mode).option("checkpointLocation", f"{base}/checkpoint")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _settle(query: StreamingQuery) -> None:
    """Wait until everything that is there by now has been processed. A trigger that had looked before may end the first wait; the next one looks again."""
    query.processAllAvailable()
    query.processAllAvailable()


def run_to_end(df: DataFrame, mode: str = "append", keys: Sequence[str] | None = None, order: Sequence[str] = (), each: Callable[[DataFrame], DataFrame] | None = None,
               write: Write | None = None) -> DataFrame | None:
    """Process all available input and return what was written.

    With `keys` the rows are upserts (and, where `_deleted` is true, deletes) of a keyed table, and the table as it stands is returned; otherwise all
    rows are. `each` is applied to every micro-batch before it is written. With a writer of its own nothing is returned. Sink, checkpoint and state
    lie in the shared work folder. A bounded input is closed once everything else has been processed; one that is replayed comes slice by slice.
    """
    spark = tune(df.sparkSession)
    base, source = f"{work_dir(spark)}/run-{uuid.uuid4().hex}", current()
    table = schema = None
    if write is None:
        schema = each(spark.createDataFrame([], df.schema)).schema if each else df.schema
        table = KeyedTable(spark, f"{base}/rows", schema, keys, order) if keys else None
        sink = table.write if table else batch_log(f"{base}/rows")
        write = (lambda batch, batch_id: sink(each(batch), batch_id)) if each else sink
    if source and source.heard:
        # One query from the first row to the last closing record: a second one would read all state back from the checkpoint. No batch is
        # run for a new watermark alone, as a closing record follows each.
        slices = source.slices()
        sliced = next(slices, None) is not None
        with ExitStack() as held:
            for key, value in {**BOUNDED_SETTINGS, **(SLICED_SETTINGS if sliced else {})}.items():
                held.enter_context(setting(spark, key, value))
            query = start_job(df, "job", base, write, mode, every="500 milliseconds")
        try:
            _settle(query)
            for _ in slices:
                _settle(query)
            late = late_rows(query)
            for _ in source.closings():
                _settle(query)
        finally:
            query.stop()
    else:
        query = start_job(df, "job", base, write, mode)
        query.awaitTermination()
        late = late_rows(query)
    if late:
        logging.getLogger(__name__).warning("%d rows came behind the watermark and were dropped", late)
    if table:
        return table.read()
    return read_log(spark, f"{base}/rows", schema) if schema is not None else None
