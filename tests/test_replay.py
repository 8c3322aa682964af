"""Tables too large for one micro-batch come in slices of their time: same rows, with less kept."""

import time

import pytest

from terrace.streaming.bounded import _slice, slice_bounds


@pytest.fixture()
def small_slices(monkeypatch):
    import importlib
    module = importlib.import_module("terrace.streaming.bounded")
    monkeypatch.setattr(module, "SLICE_ROWS", 8000)


def test_slices_hold_whole_days_and_are_narrow():
    days = [(0, 5), (1, 5), (2, 20), (3, 1), (9, 1), (10, 1)]
    assert slice_bounds(days, 10) == [2, 3]
    assert slice_bounds(days, 10, 5) == [2, 3, 9]
    assert slice_bounds([], 10) == []


def test_every_day_has_its_slice_and_no_day_the_last(spark):
    from pyspark.sql import functions as F
    days = [-5, 0, 1, 2, 3, 9, 50, None]
    rows = spark.createDataFrame([(d,) for d in days], "day int").select("day", _slice(F.col("day"), range(4), [1, 3, 9]).alias("n")).collect()
    assert {r.day: r.n for r in rows} == {-5: 0, 0: 0, 1: 1, 2: 1, 3: 2, 9: 3, 50: 3, None: 3}


class Kept:
    """Rows that each stateful operator of each query has taken into its state, and micro-batches with rows."""

    def __init__(self, spark):
        from pyspark.sql.streaming import StreamingQueryListener
        kept = self
        self.spark, self.runs, self.ended = spark, {}, 0

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                kept.runs[event.runId] = []

            def onQueryProgress(self, event):
                kept.runs[event.progress.runId].append([s.numRowsUpdated for s in event.progress.stateOperators])

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                kept.ended += 1
        self.listener = Listener()

    def __enter__(self):
        self.spark.streams.addListener(self.listener)
        return self

    def __exit__(self, *error):
        for _ in range(100):
            if self.runs and self.ended == len(self.runs):
                break
            time.sleep(0.1)
        self.spark.streams.removeListener(self.listener)


@pytest.mark.parametrize("name, jobs, copies", [("stream_order_detail_stream", 1, 1), ("live_order_cancel_fact", 2, 2), ("live_pay_success_fact", 2, 2)])
def test_slices_give_the_rows_of_one_pass_and_keep_orders_only(spark, sf_dir, small_slices, name, jobs, copies):
    from oracles import all_oracles
    from oracles.compare import compare, connect
    from terrace.plans.registry import all_queries
    from terrace.sources import load
    with Kept(spark) as kept:
        assert compare(spark, connect(sf_dir), sf_dir, all_queries()[name], all_oracles()[name]) is None
    orders, lines = load(spark, sf_dir, "orders").count(), load(spark, sf_dir, "lineitem").count()
    batches = next(iter(kept.runs.values()))
    assert len(kept.runs) == jobs and len(batches) > 6
    # All versions of orders, details that met one, and what came after the end of the orders; before, all lines and their sides, too.
    assert copies * orders <= sum(map(sum, batches)) < copies * orders + lines
    assert max(map(sum, batches)) < copies * orders


def test_a_side_without_rows_in_a_micro_batch_takes_none_from_the_other(spark, tmp_path):
    """The left row comes alone, with an empty file of closing records on the other side; the right row comes later and finds it."""
    from terrace import streaming as st
    at = "timestamp'2024-01-01'"
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    spark.sql(f"SELECT 1L AS k, {at} AS lt").write.parquet(left)
    (tmp_path / "right").mkdir()
    with st.bounded(spark) as source:
        a = st.watermark(spark.readStream.schema("k bigint, lt timestamp").parquet(left), "lt", "1 day")
        b = st.watermark(spark.readStream.schema("j bigint, rt timestamp").parquet(right), "rt", "1 day")
        closings = source.closings

        def late():
            spark.sql(f"SELECT 1L AS j, {at} AS rt").write.mode("append").parquet(right)
            yield "late"
            yield from closings()
        source.closings = late
        rows = st.run_to_end(st.interval_join(a, b, {"k": "j"}, "lt", "rt", "-1 day", "1 day"))
    assert [(r.k, r.j) for r in rows.collect()] == [(1, 1)]
