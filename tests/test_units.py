"""Operators on literal rows: the cases that tables seldom hold."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terrace import operators as op
from terrace import streaming as st
from terrace.functions import epoch_normalise, md5_bucket, pii_hash, pii_mask, second_text, weighted_avg
from terrace.functions.text import HOT_ADDRESS_BUCKETS, PHONE_STRICT, snake_case

D = date(2024, 1, 10)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.mark.parametrize("value,kind,want", [
    ("13812345678", "phone", "138*"), ("12345", "phone", None), (None, "phone", None), ("13812345678", "phone_tail", "138****5678"), ("23812345678", "phone_tail", None),
    ("a_b@x-y.com", "email", "*@x-y.com"), ("a.b@x.com", "email", None), ("a.b@x.com", "email_tail", "***@x.com"), ("nobody", "email", None), ("Ann", "name", "A*"), (None, "name", None)])
def test_masks(spark, value, kind, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(pii_mask(F.col("v"), kind)).first()[0] == want


def test_hash_of_invalid_value_is_null(spark):
    df = spark.createDataFrame([("13812345678",), ("1",), (None,)], "v string").select(pii_hash(F.col("v"), PHONE_STRICT).alias("h"))
    assert [r.h is None for r in df.collect()] == [False, True, True]


@pytest.mark.parametrize("raw,want", [("1704880800", "2024-01-10 10:00:00"), ("1704880800000", "2024-01-10 10:00:00"), ("x", None), (None, None), ("", None)])
def test_epochs(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "v string").select(second_text(epoch_normalise(F.col("v")))).first()[0] == want


def test_hot_address_has_its_own_bucket(spark):
    df = spark.createDataFrame([("0xDAC17F958D2EE523A2206206994597C13D831EC7",), ("7",)], "v string").select(md5_bucket(F.col("v"), 128, HOT_ADDRESS_BUCKETS).alias("b"))
    first, second = [r.b for r in df.collect()]
    assert first == "9002" and len(second) == 4 and int(second) < 128


def test_snake_case():
    assert [snake_case(x) for x in ("orderAmount", "stt", "Abc")] == ["order_amount", "stt", "abc"]


def test_weighted_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 6, 0), ("b", 6, 4)], "k string, x int, n int")
    assert rows(df.groupBy("k").agg(weighted_avg("x", "n"))) == [("a", None), ("b", 1.5)]


def test_three_day_run_with_a_gap(spark):
    days = {"run": (4, 5, 6), "gap": (4, 5, 7), "edge": (8, 9, 10), "old": (1, 2, 3), "repeat": (9, 9, 9)}
    df = spark.createDataFrame([(u, date(2024, 1, d)) for u, ds in days.items() for d in ds], "u string, d date")
    counts = {m: op.consecutive_days(df, "u", "d", D, method=m).first()[0] for m in ("mask", "lead", "island", "loose")}
    assert counts == {"mask": 2, "lead": 2, "island": 2, "loose": 3}


def test_topk_keeps_all_ties(spark):
    values = [("a", 9)] * 5 + [("a", 8), ("b", 3), ("b", 2), ("b", 2), ("b", 2), ("b", 1), (None, 7)]
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(values)], "k string, v int, id int")
    got = rows(op.topk_with_ties(df, ["k"], "v", 3), "k", "v", "rk")
    assert got == sorted([("a", 9, 1)] * 5 + [("b", 3, 1)] + [("b", 2, 2)] * 3 + [(None, 7, 1)], key=str)


def test_combine_keeps_one_row_for_a_key_of_any_frame(spark):
    a = spark.createDataFrame([("x", 1)], "k string, a int")
    b = spark.createDataFrame([("y", 2), ("x", 5)], "k string, b int")
    c = spark.createDataFrame([("y", 3), (None, 4)], "k string, c int")
    assert rows(op.metrics_full_outer([a, b, c], ["k"])) == sorted([("x", 1, 5, None), ("y", None, 2, 3), (None, None, None, 4)], key=str)


def test_identical_two_driver_rows_both_count(spark):
    df = spark.createDataFrame([(1, 2, 10, 1), (1, 2, 10, 1), (3, None, 7, 1), (None, None, 5, 1)], "d1 int, d2 int, km int, n int")
    out = op.split_attribution(df, [F.col("d1"), F.col("d2")], "driver", ["km"], ["n"]).groupBy("driver").agg(F.sum("km"), F.sum("n"))
    assert rows(out) == sorted([(1, 10.0, 2), (2, 10.0, 2), (3, 7.0, 1), (None, 5.0, 1)], key=str)


def test_history_table_merge(spark):
    schema = "id int, v string, start_date string, end_date string"
    history = spark.createDataFrame([(1, "a", "2024-01-01", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"), (3, None, "2024-01-01", "9999-12-31"),
                                     (1, "z", "2023-01-01", "2023-12-31")], schema)
    changes = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "id int, v string")
    got = op.scd2_merge(history, changes, "id", ["v"], D)
    want = [(1, "a", "2024-01-01", "9999-12-31"), (1, "z", "2023-01-01", "2023-12-31"), (2, "b", "2024-01-01", "2024-01-09"), (2, "B", "2024-01-10", "9999-12-31"),
            (3, None, "2024-01-01", "9999-12-31"), (4, "d", "2024-01-10", "9999-12-31")]
    assert rows(got) == sorted(want, key=str)
    assert rows(op.scd2_merge(got, changes, "id", ["v"], D)) == rows(got)


def test_page_path_is_the_same_for_large_sessions(spark):
    data = [(s, i // 3, i, "abc"[(i * 7 + s) % 3]) for s in range(4) for i in range(20)]
    df = spark.createDataFrame(data, "s int, sec int, id int, page string").withColumn("t", F.timestamp_seconds("sec"))
    plain = rows(op.page_path(df, ["s"], "page", "t", "id"))
    assert rows(op.page_path(df, ["s"], "page", "t", "id", piece_seconds=1)) == plain and sum(r[2] for r in plain) == 80


def test_page_path_keeps_rows_without_session_or_time(spark):
    df = spark.createDataFrame([(None, 5, 1, "a"), (None, 4000, 2, "b"), (None, None, 3, "c"), (7, 9, 4, "a"), (7, None, 5, "b")], "s int, sec int, id int, page string")
    for seconds in (1, 3600):
        got = rows(op.page_path(df.withColumn("t", F.timestamp_seconds("sec")), ["s"], "page", "t", "id", piece_seconds=seconds))
        assert got == sorted([("step-1:c", "step-2:a", 1), ("step-2:a", "step-3:b", 1), ("step-3:b", "null", 1), ("step-1:b", "step-2:a", 1), ("step-2:a", "null", 1)], key=str)


def test_decode_miss_is_null(spark):
    dic = spark.createDataFrame([("1", "one", "9"), ("2", "two", "8")], "dic_code string, dic_name string, parent_code string")
    df = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    assert rows(op.dict_decode(df, dic, "c", "name", "9")) == [(1, "one"), (2, None), (3, None)]


def test_snapshot_keeps_a_milestone_already_set(spark):
    old = spark.createDataFrame([(1, "2024-01-02", None), (2, None, None)], "id int, paid string, done string")
    new = spark.createDataFrame([(3,)], "id int")
    paid = spark.createDataFrame([(1, "2024-01-09"), (2, "2024-01-10 08:00:00")], "id int, at string")
    done = spark.createDataFrame([(2, "2024-01-10 09:00:00")], "id int, at string")
    got = op.accumulating_snapshot(old, new, [(paid, {"at": "paid"}), (done, {"at": "done"})], "id", "done")
    assert rows(got, "id", "paid", "dt") == [(1, "2024-01-02", "9999-12-31"), (2, "2024-01-10 08:00:00", "2024-01-10"), (3, None, "9999-12-31")]


def test_broken_json_is_dirty(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k":',), ("",), (None,), ('{"k": "x"}',)], "v string")
    good, dirty = st.parse_or_dirty(df, "v", "k bigint")
    assert rows(good, "doc.k") == [(1,)] and dirty.count() == 4


def test_cart_delta(spark):
    data = [("r", None, "5"), ("u", "2", "6"), ("u", "6", "2"), ("u", None, "3"), ("d", "1", None), ("c", None, "4")]
    df = spark.createDataFrame([(o, {"n": b}, {"n": a}) for o, b, a in data], "op string, before map<string,string>, after map<string,string>")
    assert rows(st.cdc_delta(df, "n"), "op", "delta") == [("r", 5), ("u", 4)]


def test_retraction_of_null_and_negative_amounts(spark, tmp_path):
    data = [(1, 10, Decimal("5.00")), (1, 20, None), (1, 30, Decimal("-2.00")), (1, 40, Decimal("7.00")), (2, 10, None)]
    spark.createDataFrame(data, "id int, s int, amount decimal(16,2)").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, s int, amount decimal(16,2), ts timestamp").parquet(str(tmp_path / "in"))
    out = st.run_to_end(st.retract_dedup(stream, "id", ["amount"], "ts", "1 minute"))
    amounts = [None if r.amount is None else float(r.amount) for r in out.where("id = 1").orderBy("s").collect()]
    assert sorted(amounts, key=str) == sorted([5.0, -5.0, None, None, -2.0, 2.0, 7.0], key=str)
    assert float(out.where("id = 1").agg(F.sum("amount")).first()[0]) == 7.0 and out.where("id = 2").count() == 1


def test_newest_only_drops_equal_times(spark, tmp_path):
    data = [("a", 1, 5), ("a", 2, 5), ("a", 3, 7), ("a", 4, 6), ("b", 5, 1)]
    spark.createDataFrame(data, "k string, id int, s int").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, id int, s int, ts timestamp").parquet(str(tmp_path / "in"))
    assert rows(st.run_to_end(st.newest_only(stream, ["k"], "ts", "1 minute", order=["id"])), "id") == [(1,), (3,), (5,)]


def test_state_operators_follow_their_order_whatever_the_files(spark, tmp_path):
    schema = "k string, v int, s int, amount decimal(16,2)"
    data = [("a", 3, 30, Decimal("30.00")), ("a", 1, 10, Decimal("5.00")), ("a", 2, 20, Decimal("7.00"))] + [("b", i, i, Decimal(i)) for i in range(200, 0, -1)]
    for n in (1, 4):
        frame = spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("s"))
        (frame.coalesce(1) if n == 1 else frame.repartition(n)).write.parquet(str(tmp_path / f"in{n}"))
        stream = lambda: spark.readStream.schema(schema + ", ts timestamp").parquet(str(tmp_path / f"in{n}"))  # noqa: B023,E731
        net = st.run_to_end(st.retract_dedup(stream(), "k", ["amount"], "ts", "1 hour", order=["v"])).groupBy("k").agg(F.sum("amount").cast("int").alias("net"))
        assert rows(net, "k", "net") == [("a", 30), ("b", 200)]
        newest = st.run_to_end(st.newest_only(stream(), ["k"], "ts", "1 hour", order=["s"]))
        assert newest.where("k = 'a'").count() == 3 and newest.where("k = 'b'").count() == 200
        marks = st.run_to_end(st.login_marks(stream(), "k", "ts", "1 hour", order=["ts"]))
        assert rows(marks, "k", "s") == [("a", 10), ("b", 1)]


def test_new_visitor_flag_across_days_and_batches(spark, tmp_path):
    day = 86400
    batches = [[("a", "1", 10), ("b", "0", 20)], [("a", "1", 30), ("a", "1", day + 5), ("b", "1", day + 6)], [("c", "1", 2 * day), ("a", "1", 2 * day)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "k string, flag string, s int").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("k string, flag string, s int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = rows(st.run_to_end(st.repair_is_new(stream, "k", "flag", "ts", "7 days")), "k", "s", "flag")
    assert got == sorted([("a", 10, "1"), ("a", 30, "1"), ("a", day + 5, "0"), ("a", 2 * day, "0"), ("b", 20, "0"), ("b", day + 6, "0"), ("c", 2 * day, "1")], key=str)
