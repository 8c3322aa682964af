"""Streams fed in several micro-batches give the rows that one pass over the table gives."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from terrace import streaming as st
from terrace.plans.stream_queries import QUERIES
from terrace.sources import SCHEMAS, load
from terrace.streaming.windows import PAGE_VIEW_SUMS


@pytest.fixture(scope="module")
def events(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "in")
    table = load(spark, sf_dir, "events")
    ranked = table.withColumn("part", (F.col("event_id") * 4 / (table.agg(F.max("event_id")).first()[0] + 1)).cast("int"))
    for i in range(4):
        ranked.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(path), table


def same(a, b):
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert key(a) == key(b) and a.count() > 0


def test_first_of_day(events):
    stream, table = events
    got = st.settled(st.run_to_end(st.first_of_day(stream.select("user_id", "ts"), ["user_id"], "ts")))
    same(got, table.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.min("ts").alias("ts")).drop("d"))


@pytest.mark.parametrize("files", [None, 1])
def test_first_of_day_over_shuffled_files(spark, sf_dir, tmp_path, files):
    """Eight files that each hold rows of all days, at once and one after the other: earlier rows take back later ones."""
    table = load(spark, sf_dir, "events")
    for i in range(8):
        table.where(F.pmod(F.xxhash64("event_id"), F.lit(8)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMAS["events"])
    source = (source.option("maxFilesPerTrigger", files) if files else source).parquet(str(tmp_path / "in"))
    written = st.run_to_end(st.first_of_day(source.select("user_id", "ts", "event_id"), ["user_id"], "ts", "3650 days", ["event_id"]))
    firsts = table.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.min(F.struct("ts", "event_id")).alias("f")).select("user_id", "f.*")
    same(st.settled(written), firsts)
    assert (written.where("delta < 0").count() > 0) == (files == 1)
    with st.bounded(spark):
        hours = st.run_to_end(st.unique_window(source, "ts", ["user_id"], "1 hour", "3650 days"))
    want = st.window_columns(firsts.groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("uu_ct")))
    same(hours, want)


def test_a_hot_key_leaves_a_row_per_batch_and_day_before_the_shuffle(spark):
    rows = spark.range(40_000).select(F.lit("hot").alias("_key"), (F.col("id") % 2).alias("_day"), F.col("id").alias("_us"), F.lit("r").alias("_row"))
    assert st.state._first_in_batches(rows.repartition(4), 0).count() <= 4 * 2 * 2


def test_drop_repeats(events):
    stream, table = events
    doubled = stream.select("event_id", "ts").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    same(st.run_to_end(st.drop_repeats(doubled, ["event_id", "ts"], "ts", "1 hour")), table.select("event_id", "ts"))


def test_interval_join(events):
    def sides(df):
        pick = lambda kind, p: df.where(F.col("event_type") == kind).select(F.col("event_id").alias(p + "id"), F.col("user_id").alias(p + "u"), F.col("ts").alias(p + "t"))
        return pick("click", "a"), pick("purchase", "b")
    stream, table = events
    left, right = sides(stream)
    joined = lambda l, r: st.interval_join(l, r, {"au": "bu"}, "at", "bt", "-12 hours", "5 seconds")
    same(st.run_to_end(joined(left.withWatermark("at", "1 minute"), right.withWatermark("bt", "1 minute"))), joined(*sides(table)))


def test_page_views_closed_windows_and_running_totals_agree(spark, events, tmp_path):
    stream, table = events
    dims = ["event_type"]
    shape = lambda df: df.select("ts", "user_id", "event_type", F.lit(5).alias("dur"), F.lit(None).cast("string").alias("last_page"))
    closed = st.run_to_end(st.page_view_window(shape(stream), "ts", "user_id", dims, "dur", "last_page", "6 hours"))
    parts = st.page_view_parts(shape(stream), "ts", "user_id", dims, "dur", "last_page")
    (parts.writeStream.foreachBatch(st.additive_log(str(tmp_path / "rows"), "ts", "6 hours", dims, PAGE_VIEW_SUMS)).option("checkpointLocation", str(tmp_path / "cp"))
     .trigger(availableNow=True).start().awaitTermination())
    totals = st.window_columns(st.read_additive(spark, str(tmp_path / "rows"), dims, PAGE_VIEW_SUMS))
    assert totals.agg(F.sum("pv_ct"), F.sum("uv_ct")).first() == (table.count(), table.select("user_id", F.to_date("ts")).distinct().count())
    assert closed.count() > 0 and closed.exceptAll(totals.select(*closed.columns)).count() == 0


def test_distinct_window(events):
    stream, table = events
    with st.bounded(stream.sparkSession):
        got = st.run_to_end(st.distinct_window(stream, "ts", ["event_type"], "user_id", "value", "6 hours", "1 minute"))
    want = st.window_columns(table.groupBy(F.window("ts", "6 hours"), "event_type").agg(
        F.count_distinct("user_id").alias("order_count"), F.sum(F.col("value").cast("decimal(16,2)")).cast("decimal(18,2)").alias("order_amount")))
    same(got, want)


def test_update_mode_upsert_keeps_the_newest_totals(events):
    stream, table = events
    got = st.run_to_end(st.amount_window(stream, "ts", ["event_type"], {"total": "value"}, "1 day", "2 days"), "update", ["stt", "edt", "cur_date", "event_type"])
    same(got, st.amount_window(table, "ts", ["event_type"], {"total": "value"}, "1 day"))


def entries(table):
    return sorted(map(tuple, table.read().collect()))


def test_keyed_table_takes_updates_and_deletes_in_later_batches(spark, tmp_path):
    table = st.KeyedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], ["v"])
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v int, _deleted boolean")
    assert entries(table) == []
    table.write(rows((1, 1, None), (1, 3, False), (2, 2, False)), 0)
    table.write(rows((1, 2, False), (3, 9, False)), 1)
    table.write(rows((2, 5, True)), 2)
    for _ in range(2):  # a repeated batch changes nothing
        table.write(rows((3, 10, False)), 3)
        assert entries(table) == [(1, 3), (3, 10)]
    table.write(rows((2, 6, False)), 4)
    assert entries(table) == [(1, 3), (2, 6), (3, 10)]


def test_keyed_table_stays_in_few_folders(spark, tmp_path):
    table, want = st.KeyedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], fold=3, marks=5), {}
    for i in range(30):
        gone = i % 4 == 3
        table.write(spark.createDataFrame([(i % 7, i, gone), (100 + i, i, False)], "k int, v int, _deleted boolean"), i)
        want[100 + i] = i
        want.pop(i % 7, None)
        if not gone:
            want[i % 7] = i
        if i % 10 == 9:
            assert dict(entries(table)) == want and len(table.current()) <= 2 * 4
    assert len(list((tmp_path / "t").glob("level=*/upto=*"))) <= 2 * 3 * 4
    st.KeyedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], fold=3, marks=5).write(spark.createDataFrame([(103, 0, True)], "k int, v int, _deleted boolean"), 30)
    assert 103 not in dict(entries(table))


def parts_of(spark, path, schema, *batches):
    """A stream with a micro-batch for each list of rows."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_facts_follow_updates_and_deletes(spark, tmp_path):
    from terrace.plans import live
    row = lambda text: {"id": "7", "user_id": "1", "sku_id": "2", "appraise": "1201", "comment_txt": text}
    records = [[("c", None, row("a"), {"table": "comment_info"}, 1000), ("c", None, {**row("x"), "id": "8"}, {"table": "comment_info"}, 1000)],
               [("u", row("a"), row("b"), {"table": "comment_info"}, 2000)], [("d", {**row("x"), "id": "8"}, None, {"table": "comment_info"}, 3000)]]
    cdc = parts_of(spark, str(tmp_path / "cdc"), st.cdc.CDC_SCHEMA, *records)
    dictionary = spark.createDataFrame([("1201", "good")], "dic_code string, dic_name string")
    rows = st.run_to_end(live.comment_fact(cdc, dictionary), keys=["id"], order=["event_time"]).collect()
    assert [(r.id, r.comment_txt, r.appraise_name) for r in rows] == [("7", "b", "good")]


def test_a_dimension_that_changes_between_batches(spark, tmp_path):
    stream = parts_of(spark, str(tmp_path / "in"), "k int, batch int", [(1, 0)], [(1, 1)], [(1, 2)])
    dim = st.KeyedTable(spark, str(tmp_path / "dim"), "k int, name string", ["k"])
    dim.write(spark.createDataFrame([(1, "before")], "k int, name string"), 0)

    def run(max_age):
        fresh = st.refreshed(dim.read, max_age)

        def each(batch):
            out = st.lookup(batch, fresh(), ("k", "k"), {"name": "name"})
            if not batch.where("batch = 0").isEmpty():
                rows = out.collect()  # as of the first batch
                dim.write(spark.createDataFrame([(1, "after")], "k int, name string"), 1)
                return spark.createDataFrame(rows, out.schema)
            return out
        return {r.batch: r.name for r in st.run_to_end(stream, each=each).collect()}
    assert run(0) == {0: "before", 1: "after", 2: "after"}


def test_a_job_goes_on_from_its_checkpoint(spark, tmp_path):
    schema = "k int, ts timestamp"
    source = parts_of(spark, str(tmp_path / "in"), schema, *[[(i % 3, None), (i, None)] for i in range(6)])
    counts = source.groupBy("k").count()
    table = st.KeyedTable(spark, str(tmp_path / "out"), counts.schema, ["k"])
    job = st.start_job(counts, "counts", str(tmp_path / "jobs"), table.write, "update", every="200 milliseconds")
    while job.isActive and (job.lastProgress is None or job.lastProgress["batchId"] < 1):
        time.sleep(0.05)
    job.stop()
    stopped = len(table._folders()[0])
    again = st.start_job(counts, "counts", str(tmp_path / "jobs"), table.write, "update")
    again.awaitTermination()
    assert 2 <= stopped and again.recentProgress[0]["batchId"] >= 2
    want = {}
    for i in range(6):
        for k in (i % 3, i):
            want[k] = want.get(k, 0) + 1
    assert dict(entries(table)) == want


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    start = datetime(2024, 1, 1)
    at = lambda minutes: (minutes, start + timedelta(minutes=minutes))
    stream = parts_of(spark, str(tmp_path / "in"), "k int, ts timestamp", [at(0), at(60)], [at(5), at(59)], [at(120)], [at(61), at(119)], [at(62)])
    listener = st.watch_late_rows(spark)
    side = st.LateSide(spark, str(tmp_path / "side"), "ts", "10 minutes")
    windows = st.watermark(stream, "ts", "10 minutes").groupBy(F.window("ts", "1 minute")).count()
    query = st.start_job(windows, "windows", str(tmp_path / "jobs"))
    query.awaitTermination()
    st.start_job(stream, "late", str(tmp_path / "jobs"), side.write).awaitTermination()
    assert sorted(r.k for r in side.read(stream.schema).collect()) == [5, 61, 62]
    for _ in range(100):
        if listener.of(query):
            break
        time.sleep(0.1)
    assert listener.of(query) == st.late_rows(query) == 1  # operators hold a batch's rows against the watermark of the batch before
    spark.streams.removeListener(listener)


def test_snapshot_and_changes_in_any_order(spark, tmp_path):
    record = lambda op, i, ts: (op, None, {"id": str(i)}, {"table": "t"}, ts)
    snapshot = parts_of(spark, str(tmp_path / "s"), st.cdc.CDC_SCHEMA, [record("r", 1, 1000), record("r", 2, 1000)], [record("r", 3, 5000)])
    changes = parts_of(spark, str(tmp_path / "c"), st.cdc.CDC_SCHEMA, [record("u", 1, 900), record("u", 2, 2000)], [record("u", 2, 2000), record("u", 3, 4000), record("u", 3, 5000), record("u", 3, 6000)])
    out = st.run_to_end(st.hand_over(snapshot, changes, "1 day"))
    assert sorted((r.after["id"], r.op, r.ts_ms) for r in out.collect()) == [("1", "r", 1000), ("2", "r", 1000), ("2", "u", 2000), ("3", "r", 5000), ("3", "u", 6000)]


SHUFFLED = ["stream_first_of_day", "stream_unique_window", "stream_login_window_back", "live_log_splitter", "live_page_view_metrics"]
IN_TURN = ["stream_first_of_day", "stream_interval_join", "stream_page_view_window", "stream_retract_dedup", "live_login_users"]


TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate", "conversations": "conv_id"}


@pytest.fixture(scope="module")
def layouts(spark, sf_dir, tmp_path_factory):
    """The tables in four files each: rows dealt at random, and slices of time in their order with rows mixed inside."""
    root = tmp_path_factory.mktemp("layouts")
    for name in SCHEMAS:
        if name == "documents":
            continue
        table = load(spark, sf_dir, name)
        mixed = F.xxhash64(*table.columns)
        ranked = table.withColumn("_part", F.pmod(mixed, F.lit(4)))
        if name in TIMES:
            cuts = sorted(r[0] for r in table.select(TIMES[name]).distinct().collect())
            cuts = [cuts[len(cuts) * i // 4] for i in range(1, 4)]
            late = sum(((F.col(TIMES[name]) >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
        else:
            late = F.col("_part")
        for layout, part in (("shuffled", F.col("_part")), ("in_turn", late)):
            for i in range(4):
                ranked.where(part == i).drop("_part").coalesce(1).sortWithinPartitions(mixed).write.mode("append").parquet(f"{root}/{layout}/{name}.parquet")
    return root


@pytest.mark.parametrize("layout, name", [*(("shuffled", n) for n in SHUFFLED), *(("in_turn", n) for n in IN_TURN)])
def test_queries_whatever_the_layout(spark, sf_dir, layouts, layout, name):
    from oracles import all_oracles
    from oracles.compare import compare, connect
    from terrace.plans.registry import all_queries
    if layout == "in_turn":
        spark.conf.set("terrace.stream.files", "1")
    try:
        outcome = compare(spark, connect(sf_dir), sf_dir, lambda s, _: all_queries()[name](s, f"{layouts}/{layout}"), all_oracles()[name])
    finally:
        spark.conf.unset("terrace.stream.files")
    assert outcome in (None, "EMPTY")


def test_bounded_run_is_one_query_with_one_store_per_partition_of_a_join(spark, sf_dir):
    from pyspark.sql.streaming import StreamingQueryListener

    class Seen(StreamingQueryListener):
        def __init__(self):
            self.runs, self.batches, self.ended = set(), [], 0

        def onQueryStarted(self, event):
            self.runs.add(event.runId)

        def onQueryProgress(self, event):
            self.batches.append([s.numStateStoreInstances for s in event.progress.stateOperators])

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            self.ended += 1

    seen = Seen()
    spark.streams.addListener(seen)
    try:
        QUERIES["stream_order_detail_stream"](spark, sf_dir).count()
        for _ in range(100):
            if seen.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    stores = {n for batch in seen.batches for n in batch}
    assert len(seen.runs) == 1 and stores == {int(spark.conf.get("spark.sql.shuffle.partitions"))}
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


@pytest.mark.parametrize("name", ["stream_repair_is_new", "stream_first_of_day", "stream_retract_dedup", "stream_page_view_window", "stream_page_view_totals", "stream_unique_window", "stream_home_detail_window",
                                  "stream_login_window_back", "stream_amount_window", "stream_newest_only", "stream_hand_over", "live_log_splitter", "live_cart_unique_users", "live_province_orders",
                                  "live_sku_orders", "live_home_detail_visitors", "live_page_view_metrics", "live_login_users"])
def test_buckets_grow_with_the_rows_of_a_query(spark, sf_dir, monkeypatch, name):
    from terrace.plans.registry import all_queries
    from terrace.streaming import state

    class Dealt(Exception):
        pass

    def deal(df, keys, processor, ts, delay, order, buckets, **options):
        raise Dealt(buckets)

    monkeypatch.setattr(state, "ROWS_PER_BUCKET", 10)
    monkeypatch.setattr(state, "_transform", deal)
    with pytest.raises(Dealt) as found:
        all_queries()[name](spark, sf_dir)
    assert found.value.args[0] > state.BUCKETS == state.buckets_for(0)
