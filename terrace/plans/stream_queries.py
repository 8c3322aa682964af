"""One query per streaming operator: the given tables are read as file streams and run to the end."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import streaming as st
from terrace.functions import money, second_text
from terrace.session import tune, work_dir
from terrace.sources import load
from terrace.sources.readers import SCHEMAS, stream, stream_table
from terrace.streaming.bounded import current
from terrace.streaming.runs import run_to_end
from terrace.streaming.windows import login_window

QUERIES = {}


class Streams:
    """Attribute access to the given tables as streams; static(name) for dimensions."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.late = tune(spark), sf_dir, {}  # late: by how many days a table comes after the others

    def __getattr__(self, name: str) -> DataFrame:
        files = self.spark.conf.get("terrace.stream.files", None)  # how many files make a micro-batch; all, unless set
        return stream_table(self.spark, self.sf_dir, name, int(files) if files else None)

    def static(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    def buckets(self, name: str, copies: int = 1) -> int:
        """Buckets of keyed state for the rows of a table, which files' footers count, each `copies` times."""
        return st.buckets_for(copies * self.stored(name).count())

    def in_time_order(self, tables: Mapping[str, tuple[DataFrame, str]], lags: Callable[[int], Mapping[str, int]] = lambda width: {}) -> Streams:
        """These tables, of which the given ones (rows, time column) come in slices of their time if they are too many for one micro-batch."""
        found = Streams(self.spark, self.sf_dir)
        streams, found.late = current().replayed(tables, lags)
        vars(found).update(streams)
        return found

    def orders_and_lines(self) -> Streams:
        """Orders, lines and, as `activities` and `coupons`, lines once more for these. In slices, orders come so early, and activities and coupons so late,
        that only orders have to be kept: by the range of their join, the delay, a slice, and what the joins before hold back."""
        lines = self.stored("lineitem")

        def lags(width: int) -> dict[str, int]:
            early = 30 + 2 + width
            activities = early + 30 + 1 + 2 + width
            return {"orders": -early, "activities": activities, "coupons": activities + early + 30 + 1 + 1 + 2 + width}
        found = self.in_time_order({"orders": (self.stored("orders"), "o_orderdate"), **dict.fromkeys(("lineitem", "activities", "coupons"), (lines, "l_shipdate"))}, lags)
        for name in ("activities", "coupons"):
            if name not in vars(found):
                setattr(found, name, found.lineitem)
        return found

    @property
    def late_times(self) -> dict[str, int]:
        """`late` by the times in a detail's joins."""
        names = {"orders": "header_time", "activities": "act_time", "coupons": "cou_time"}
        return {names[name]: days for name, days in self.late.items()}

    def stored(self, name: str) -> DataFrame:
        """A table as it is stored, one file or a folder of parts."""
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet*")

    def again(self, rows: DataFrame) -> DataFrame:
        """Rows as a stream of their own: what one job has written is the next one's source."""
        path = f"{work_dir(self.spark)}/topic-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return stream(self.spark, path, rows.schema)

    def in_turn(self, *parts: DataFrame) -> DataFrame:
        """Frames of one schema as a stream with a micro-batch for each."""
        path = f"{work_dir(self.spark)}/topic-{uuid.uuid4().hex}"
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(path)
        return stream(self.spark, path, parts[0].schema, files_per_trigger=1)


def bounded_query(queries: dict, prefix: str):
    """Register queries over inputs that end: after the last row a closing record lets open windows and unmatched rows out."""
    def query(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = Streams(spark, sf_dir)
            with st.bounded(t.spark):
                return fn(t)
        queries[f"{prefix}_{fn.__name__}"] = run
        return fn
    return query


query = bounded_query(QUERIES, "stream")


def _texts(df: DataFrame) -> DataFrame:
    """Timestamps as text, to the microsecond where there is one."""
    return df.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


def _props(t):
    broken = F.when(F.expr("event_id % 13 = 0"), F.substring("props", 1, 4)).otherwise(F.col("props"))
    return t.events.select("event_id", broken.alias("props"))


@query
def parse_good(t):
    good, _ = st.parse_or_dirty(_props(t), "props", "k bigint")
    return run_to_end(good.select("event_id", "doc.k"))


@query
def parse_dirty(t):
    _, dirty = st.parse_or_dirty(_props(t), "props", "k bigint")
    return run_to_end(dirty)


@query
def repair_is_new(t):
    rows = t.events.select("event_id", "user_id", "ts", F.expr("cast(event_id % 2 as string)").alias("is_new"))
    out = run_to_end(st.repair_is_new(rows, "user_id", "is_new", "ts", "1 hour", order=["ts", "event_id"], buckets=t.buckets("events")))
    return out.select("event_id", "user_id", "is_new")


def _nested_log(t):
    item = lambda k: F.struct((F.col("event_id") % k).alias("item"), F.lit(k).alias("pos"))
    return t.events.select(
        F.struct(F.col("user_id").alias("mid"), F.lit("c1").alias("ch")).alias("common"), F.struct(F.col("event_type").alias("page_id")).alias("page"),
        F.when(F.col("event_type") == "view", F.array(item(10), item(7))).alias("displays"), F.when(F.col("event_type") == "click", F.array(item(5))).alias("actions"),
        F.when(F.col("event_type") == "error", F.struct((F.col("event_id") % 3).alias("code"))).alias("err"),
        F.when(F.col("event_type") == "signup", F.struct(F.lit("icon").alias("entry"))).alias("start"), F.unix_millis("ts").alias("ts"))


@query
def split_log(t):
    detail = F.coalesce("err.code", F.when(F.col("kind").isin("start", "page"), F.col("common.mid")), "display.item", "action.item")
    return run_to_end(st.split_log(_nested_log(t)).select("kind", "ts", detail.cast("bigint").alias("detail")))


def _order_changes(orders: DataFrame) -> DataFrame:
    after = F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("user_id"), F.col("o_custkey").cast("string"),
                         F.lit("order_status"), F.col("o_orderstatus"), F.lit("total_amount"), money("o_totalprice").cast("string"))
    before = F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("order_status"), F.when(F.expr("o_orderkey % 3 = 0"), F.col("o_orderstatus")).otherwise(F.lit("N")))
    op = F.element_at(F.array(*[F.lit(x) for x in "rcud"]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return orders.select(op.alias("op"), before.alias("before"), after.alias("after"),
                         F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.when(F.expr("o_orderkey % 5 = 0"), F.lit("other")).otherwise(F.lit("order_info"))).alias("source"),
                         F.unix_millis("o_orderdate").alias("ts_ms"))


@query
def cdc_select(t):
    rows = st.cdc_select(_order_changes(t.orders), "order_info", ["u"], {"id": "id bigint", "user_id": "user_id bigint", "total_amount": "amount decimal(18,2)"},
                         status={"order_status": ["F", "O"]}, changed="order_status")
    return _texts(run_to_end(rows))


@query
def cdc_envelope(t):
    rows = st.cdc_envelope(_order_changes(t.orders))
    return run_to_end(rows.select("id", "op", "db", "table", F.col("after")["order_status"].alias("status"), "ts"))


@query
def cdc_delta(t):
    qty = F.col("l_quantity").cast("bigint").cast("string")
    rows = t.lineitem.select("l_orderkey", F.element_at(F.array(*[F.lit(x) for x in "rcud"]), (F.col("l_partkey") % 4 + 1).cast("int")).alias("op"),
                             F.create_map(F.lit("sku_num"), (F.col("l_linenumber") * 7).cast("string")).alias("before"), F.create_map(F.lit("sku_num"), qty).alias("after"))
    out = run_to_end(st.cdc_delta(rows, "sku_num").select("l_orderkey", "delta"))
    return out.groupBy("l_orderkey").agg(F.sum("delta").alias("gained"), F.count(F.lit(1)).alias("changes"))


def line_id():
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"))


def _details(t):
    return t.lineitem.select(line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"), money("l_extendedprice").alias("amount"),
                             F.col("l_shipdate").alias("detail_time")).transform(st.watermark, "detail_time", "1 day")


def _headers(t, *extra):
    return t.orders.select(F.col("o_orderkey").alias("header_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("order_status"),
                           F.col("o_orderdate").alias("header_time"), *extra).transform(st.moved, "header_time", t.late.get("orders", 0)).transform(st.watermark, "header_time", "1 day")


@query
def order_detail_stream(t):
    t = t.orders_and_lines()
    activity = t.activities.where("l_discount > 0.05").select(line_id().alias("act_detail_id"), (F.col("l_suppkey") % 25).alias("activity_id"), F.col("l_shipdate").alias("act_time"))
    coupon = t.coupons.where("l_tax > 0.04").select(line_id().alias("cou_detail_id"), F.col("l_suppkey").alias("coupon_id"), F.col("l_shipdate").alias("cou_time"))
    activity = activity.transform(st.moved, "act_time", t.late.get("activities", 0)).transform(st.watermark, "act_time", "1 day")
    coupon = coupon.transform(st.moved, "cou_time", t.late.get("coupons", 0)).transform(st.watermark, "cou_time", "1 day")
    rows = st.order_detail_stream(_details(t), _headers(t), activity, coupon, "-30 days", "30 days", "-1 day", "1 day", t.late_times)
    return run_to_end(rows.select("id", "order_id", "user_id", "amount", "activity_id", "coupon_id"))


@query
def cancel_stream(t):
    rows = st.cancel_stream(_details(t), _headers(t), "order_status", ["F"], "-30 days", "30 days")
    return run_to_end(rows.select("id", "order_id", "user_id", "sku_id", "amount"))


def _events_of(t, kind, prefix):
    return t.events.where(F.col("event_type") == kind).select(F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"),
                                                              F.col("ts").alias(f"{prefix}_time"), (F.col("event_id") % 5).alias(f"{prefix}_code")).transform(st.watermark, f"{prefix}_time", "10 seconds")


def _codes(spark, names):
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in names.items()) + " AS d(dic_code, dic_name)")


PAY_NAMES = {"0": "alipay", "1": "wechat", "2": "unionpay", "3": "card"}


@query
def interval_join(t):
    rows = st.interval_join(_events_of(t, "click", "order"), _events_of(t, "purchase", "pay"), {"order_user": "pay_user"}, "order_time", "pay_time", "-30 minutes", "5 seconds")
    rows = st.lookup(rows, _codes(t.spark, PAY_NAMES), ("pay_code", "dic_code"), {"dic_name": "pay_name"})
    return run_to_end(rows.select("order_id", "pay_id", "pay_user", "pay_name"))


@query
def interval_merge(t):
    rows = st.interval_merge(_events_of(t, "click", "c"), _events_of(t, "view", "v"), {"c_user": "v_user"}, "c_time", "v_time", "-10 minutes", "10 minutes")
    return run_to_end(rows.select("c_id", "c_user", "info_v_id", "info_v_code"))


@query
def refund_stream(t):
    refunds = (t.lineitem.where("l_returnflag = 'R'").select(line_id().alias("id"), F.col("l_orderkey").alias("order_id"), (F.col("l_partkey") % 5).alias("refund_type"),
                                                            (F.col("l_suppkey") % 5).alias("reason"), F.col("l_shipdate").alias("refund_time")).transform(st.watermark, "refund_time", "1 day"))
    dic = _codes(t.spark, PAY_NAMES)
    rows = st.refund_stream(refunds, _headers(t).where("order_status = 'F'"), "-30 days", "30 days",
                            [(dic, ("refund_type", "dic_code"), {"dic_name": "type_name"}), (dic, ("reason", "dic_code"), {"dic_name": "reason_name"})])
    return run_to_end(rows.select("id", "order_id", "user_id", "type_name", "reason_name"))


@query
def refund_paid_stream(t):
    pay = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"), (F.col("l_suppkey") % 5).alias("pay_type"),
                                                       money("l_extendedprice").cast("decimal(18,2)").alias("paid"), F.col("l_shipdate").alias("pay_time")).transform(st.watermark, "pay_time", "1 day")
    refund = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("refund_order_id"), F.col("l_partkey").alias("refund_sku_id"), F.col("l_linenumber").alias("refund_num"),
                                                          F.col("l_shipdate").alias("refund_time")).transform(st.watermark, "refund_time", "1 day")
    rows = st.refund_paid_stream(pay, refund, _headers(t), "-30 days", "30 days", [(_codes(t.spark, PAY_NAMES), ("pay_type", "dic_code"), {"dic_name": "pay_name"})])
    return run_to_end(rows.select("order_id", "sku_id", "user_id", "refund_num", "paid", "pay_name"))


@query
def lookup(t):
    dic = _codes(t.spark, {"user": "customer", "assistant": "agent"})
    return run_to_end(st.lookup(t.conversations.select("conv_id", "turn", "role"), dic, ("role", "dic_code"), {"dic_name": "role_name"}, default="N/A"))


@query
def enrich_chain(t):
    steps = [(t.static("supplier"), ("l_suppkey", "s_suppkey"), {"s_name": "supplier", "s_nationkey": "nation_key"}),
             (t.static("nation"), ("nation_key", "n_nationkey"), {"n_name": "nation", "n_regionkey": "region_key"}),
             (t.static("region"), ("region_key", "r_regionkey"), {"r_name": "region"}),
             (t.static("part"), ("l_partkey", "p_partkey"), {"p_brand": "brand"})]
    out = run_to_end(st.enrich_chain(t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey"), steps))
    return out.groupBy("brand", "region", "nation").agg(F.count(F.lit(1)).alias("lines"), F.max("supplier").alias("last_supplier"))


@query
def first_of_day(t):
    return _texts(st.settled(run_to_end(st.first_of_day(t.events.select("user_id", "ts"), ["user_id"], "ts", buckets=t.buckets("events")))))


def _versions(t):
    """Every order comes twice; the second version of every third order has another amount."""
    amount = money("o_totalprice")
    one = F.struct(F.lit(1).alias("version"), amount.alias("amount"))
    two = F.struct(F.lit(2).alias("version"), F.when(F.expr("o_orderkey % 3 = 0"), amount + 10).otherwise(amount).cast("decimal(16,2)").alias("amount"))
    return t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("province_id"), F.col("o_orderdate").alias("ts"), F.inline(F.array(one, two)))


@query
def retract_dedup(t):
    out = run_to_end(st.retract_dedup(_versions(t), "id", ["amount"], "ts", "1 day", order=["ts", "version"], buckets=t.buckets("orders", 2)))
    return _texts(out).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


@query
def emit_last(t):
    out = run_to_end(st.emit_last(_versions(t), "id", "ts", "1 day", "1 day", ["ts", "version"]))
    return _texts(out).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


@query
def keyword_counts(t):
    rows = t.conversations.select("text", F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn")).alias("ts"))
    return run_to_end(st.keyword_counts(rows, "text", "ts", "10 minutes", "3 seconds"))


def _pages(t):
    return t.events.select("event_id", "ts", "user_id", F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("vc"), F.concat(F.lit("c"), (F.col("user_id") % 2).cast("string")).alias("ch"),
                           "event_type", (F.col("value") * 100).cast("bigint").alias("dur"), F.when(F.expr("event_id % 3 = 0"), F.lit(None)).otherwise(F.lit("list")).alias("last_page_id"))


@query
def page_view_window(t):
    return run_to_end(st.page_view_window(_pages(t), "ts", "user_id", ["vc", "ch", "event_type"], "dur", "last_page_id", "1 hour", order=["event_id"], buckets=t.buckets("events")))


@query
def page_view_totals(t):
    """The same measures without waiting for windows to close: partial sums per micro-batch, added up when read."""
    path = f"{work_dir(t.spark)}/totals-{uuid.uuid4().hex}"
    dims = ["vc", "ch", "event_type"]
    parts = st.page_view_parts(_pages(t), "ts", "user_id", dims, "dur", "last_page_id", order=["event_id"], buckets=t.buckets("events"))
    (parts.writeStream.foreachBatch(st.additive_log(f"{path}/rows", "ts", "1 hour", dims, st.windows.PAGE_VIEW_SUMS)).option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return st.window_columns(st.read_additive(t.spark, f"{path}/rows", dims, st.windows.PAGE_VIEW_SUMS))


@query
def unique_window(t):
    return run_to_end(st.unique_window(t.events.where("event_type = 'purchase'"), "ts", ["user_id"], "1 hour", name="cart_add_uu_ct", buckets=t.buckets("events")))


@query
def home_detail_window(t):
    flags = {"home_uv_ct": F.col("event_type") == "view", "good_detail_uv_ct": F.col("event_type") == "click"}
    return run_to_end(st.unique_window(t.events, "ts", ["user_id"], "1 hour", flags=flags, buckets=t.buckets("events")))


@query
def login_window_back(t):
    rows = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return run_to_end(login_window(rows, "ts", "user_id", "1 hour", "5 seconds", back_days=3, order=["ts", "event_id"], buckets=t.buckets("events")))


@query
def amount_window(t):
    clean = st.retract_dedup(_versions(t), "id", ["amount"], "ts", "1 day", order=["ts", "version"], buckets=t.buckets("orders", 2))
    return run_to_end(st.amount_window(clean, "ts", ["province_id"], {"order_amount": "amount"}, "1 day"))


@query
def amount_window_upsert(t):
    """Totals per key as they stand now: update mode into the keyed change log."""
    rows = t.lineitem.withColumn("discount", money("l_extendedprice") * money("l_discount"))
    sums = st.amount_window(rows, "l_shipdate", ["l_partkey"], {"original_amount": "l_extendedprice", "activity_amount": "discount"}, "30 days", "1 day")
    return run_to_end(sums, "update", ["stt", "edt", "cur_date", "l_partkey"])


@query
def distinct_window(t):
    return run_to_end(st.distinct_window(_versions(t), "ts", ["province_id"], "id", "amount", "30 days", "1 day"))


@query
def newest_only(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("ts"))
    return _texts(run_to_end(st.newest_only(rows, ["o_custkey"], "ts", "1 day", None, order=["o_orderkey"], buckets=t.buckets("orders"))))


@query
def drop_repeats(t):
    doubled = t.events.select("event_id", "ts", F.explode(F.sequence(F.lit(1), (F.col("event_id") % 3 + 1).cast("int"))).alias("copy")).drop("copy")
    return _texts(run_to_end(st.drop_repeats(doubled, ["event_id", "ts"], "ts", "1 hour")))


@query
def upsert_log(t):
    """The newest order per customer; customers whose newest order is open are deleted."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", (F.col("o_orderstatus") == "P").alias("_deleted"))
    return _texts(run_to_end(rows, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"]))


@query
def hand_over(t):
    """A snapshot of the orders, and changes of which some are in the snapshot already."""
    row = F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("status"), F.col("o_orderstatus"))

    def records(orders, op, ts):
        return orders.select(F.lit(op).alias("op"), F.lit(None).cast("map<string,string>").alias("before"), row.alias("after"), F.create_map(F.lit("table"), F.lit("order_info")).alias("source"), ts.alias("ts_ms"))
    at = F.unix_millis("o_orderdate")
    changes = records(t.orders.where("o_orderkey % 3 = 0"), "u", at - 1000).unionByName(records(t.orders.where("o_orderkey % 3 = 1"), "u", at)).unionByName(records(t.orders.where("o_orderkey % 5 = 0"), "u", at + 1000))
    out = run_to_end(st.hand_over(records(t.orders, "r", at), changes, "1 day", buckets=t.buckets("orders", 2)))
    return out.select("op", F.col("after")["id"].alias("id"), F.col("after")["status"].alias("status"), "ts_ms")


@query
def dated_sink(t):
    path = f"{work_dir(t.spark)}/dated-{uuid.uuid4().hex}"
    epoch = F.when(F.expr("event_id % 50 = 0"), F.lit("bad")).when(F.expr("event_id % 2 = 0"), F.unix_seconds("ts").cast("string")).otherwise(F.unix_millis("ts").cast("string"))
    st.dated_sink(t.events.select("event_id", epoch.alias("ts")), "ts", f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    lines = t.spark.read.schema("value string, day string").text(f"{path}/rows")
    return lines.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.get_json_object("value", "$.event_id").cast("bigint")).alias("id_sum"))


@query
def route_dims(t):
    config = t.spark.sql("SELECT * FROM VALUES ('customer', 'dim_user', 'id', 'id,name'), ('part', 'dim_sku', 'id', null) AS c(source_table, sink_table, sink_row_key, sink_columns)")
    op = F.when(F.expr("key % 10 = 9"), F.lit("d")).otherwise(F.lit("u"))

    def changes(df, table, key, name, extra):
        return df.select(F.lit(table).alias("table"), F.col(key).alias("key"), F.create_map(F.lit("id"), F.col(key).cast("string"), F.lit("name"), F.col(name), F.lit("extra"), F.col(extra)).alias("after"))
    rows = changes(t.customer, "customer", "c_custkey", "c_name", "c_mktsegment").unionByName(changes(t.part, "part", "p_partkey", "p_name", "p_brand")).unionByName(
        changes(t.supplier, "supplier", "s_suppkey", "s_name", "s_name"))
    cdc = rows.select(op.alias("op"), "after", F.create_map(F.lit("table"), F.col("table")).alias("source"), F.col("key").alias("ts_ms"))
    out = run_to_end(st.route_dims(cdc, config))
    pairs = F.transform(F.array_sort(F.map_entries("values")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("sink_table", "row_key", F.array_join(pairs, ";").alias("cells"))


@query
def flag_words_query(t):
    words = t.spark.sql("SELECT * FROM VALUES ('system'), ('assistant'), ('assistant') AS w(word)")
    msg = F.when(F.expr("conv_id % 3 = 0"), F.concat_ws(",", "text", "role")).otherwise(F.col("text"))
    out = run_to_end(st.flag_words(t.conversations.select("conv_id", "turn", msg.alias("msg")), "msg", words))
    return out.select("conv_id", "turn", "is_violation", "violation_grade", "violation_msg")


QUERIES["stream_flag_words"] = QUERIES.pop("stream_flag_words_query")


@query
def snake_json(t):
    rows = t.supplier.select(F.col("s_suppkey").alias("suppKey"), F.col("s_name").alias("supplierName"), F.col("s_nationkey").alias("nationKey"))
    return run_to_end(st.to_snake_json(rows, exclude=["nationKey"]))
