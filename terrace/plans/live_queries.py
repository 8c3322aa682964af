"""The real-time jobs over the given tables, reshaped as change records and logs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace import streaming as st
from terrace.functions import money
from terrace.plans import live
from terrace.plans.raw_shop import RAW
from terrace.plans.stream_queries import _texts, bounded_query, line_id
from terrace.plans.warehouse import derived_reader
from terrace.session import work_dir
from terrace.streaming.runs import run_to_end

QUERIES = {}
NEAR, SIDE = ("-30 days", "30 days"), ("-1 day", "1 day")
DAY = "1 day"


query = bounded_query(QUERIES, "live")


def _changes(df: DataFrame, table: str, op: str | Column, ts: str, after: Mapping[str, Column], before: Mapping[str, Column] | None = None) -> DataFrame:
    def cells(columns):
        return F.create_map(*[x for k, c in columns.items() for x in (F.lit(k), c.cast("string"))])
    return df.select((F.lit(op) if isinstance(op, str) else op).alias("op"), (cells(before) if before else F.lit(None).cast("map<string,string>")).alias("before"),
                     cells(after).alias("after"), F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.lit(table)).alias("source"), F.unix_millis(ts).alias("ts_ms"))


C = F.col

def _status():
    return F.when(C("o_orderstatus") == "F", "1003").when(C("o_orderstatus") == "O", "1005").otherwise("1006")


def order_changes(t):
    row = {"id": C("o_orderkey"), "user_id": C("o_custkey"), "province_id": C("o_custkey") % 25, "operate_time": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")}
    new = _changes(t.orders, "order_info", "c", "o_orderdate", {**row, "order_status": F.lit("1001")})
    return new.unionByName(_changes(t.orders, "order_info", "u", "o_orderdate", {**row, "order_status": _status()}, {"order_status": F.lit("1001")}))


def detail_changes(t):
    split = money(money("l_extendedprice") * money("l_discount"))
    return _changes(t.lineitem, "order_detail", "c", "l_shipdate", {
        "id": line_id(), "order_id": C("l_orderkey"), "sku_id": C("l_partkey"), "sku_name": F.concat(F.lit("sku-"), C("l_partkey").cast("string")), "sku_num": C("l_quantity").cast("bigint"),
        "create_time": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), "order_price": money("l_extendedprice"), "split_activity_amount": split, "split_coupon_amount": F.lit(0), "split_total_amount": money("l_extendedprice")})


def side_changes(t):
    act = _changes(t.activities.where("l_discount > 0.05"), "order_detail_activity", "c", "l_shipdate",
                   {"order_detail_id": line_id(), "activity_id": C("l_suppkey") % 25, "activity_rule_id": C("l_suppkey")})
    return act.unionByName(_changes(t.coupons.where("l_tax > 0.04"), "order_detail_coupon", "c", "l_shipdate", {"order_detail_id": line_id(), "coupon_id": C("l_suppkey")}))


def refund_changes(t):
    lines = t.lineitem.where("l_returnflag = 'R'")
    row = {"id": line_id(), "user_id": C("l_suppkey"), "order_id": C("l_orderkey"), "sku_id": C("l_partkey"), "create_time": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
           "refund_reason_txt": F.concat(F.lit("reason "), C("l_suppkey").cast("string")), "refund_type": 1101 + C("l_partkey") % 4, "refund_reason_type": 1201 + C("l_suppkey") % 4,
           "refund_num": C("l_quantity").cast("bigint"), "refund_amount": money("l_extendedprice")}
    asked = _changes(lines, "order_refund_info", "c", "l_shipdate", {**row, "refund_status": F.lit("0701")})
    done = _changes(lines.where("l_linestatus = 'F'"), "order_refund_info", "u", "l_shipdate", {**row, "refund_status": F.lit("0705")}, {"refund_status": F.lit("0701")})
    paid = _changes(lines.where("l_partkey % 2 = 0"), "refund_payment", "u", "l_shipdate",
                    {"id": line_id(), "order_id": C("l_orderkey"), "sku_id": C("l_partkey"), "payment_type": 1101 + C("l_partkey") % 4, "total_amount": money("l_extendedprice"),
                     "refund_status": F.lit("1602")}, {"refund_status": F.lit("1601")})
    return asked.unionByName(done).unionByName(paid)


def cart_changes(t):
    op = F.when(C("l_partkey") % 2 == 0, "r").otherwise("u")
    return _changes(t.lineitem, "cart_info", op, "l_shipdate", {"id": line_id(), "user_id": C("l_suppkey"), "sku_id": C("l_partkey"), "sku_num": C("l_quantity").cast("bigint")},
                    {"sku_num": C("l_linenumber") * 7})


def log_stream(t) -> DataFrame:
    """The raw shop log statement over the event stream."""
    return t.spark.sql(RAW["ods_z_log"], events=t.events).select("log")


def _dim(t, name):
    return derived_reader(t.spark, t.sf_dir, RAW)(name)


def _full_logs(t):
    """The shop's logs, some with displays, actions or as start records, and some cut off."""
    more = F.concat(
        F.when(C("id") % 4 == 1, F.concat(F.lit(',"displays":[{"item":"'), (C("id") % 10).cast("string"), F.lit('","pos_id":"1"},{"item":"'), (C("id") % 7).cast("string"), F.lit('"}]'))).otherwise(""),
        F.when(C("id") % 4 == 2, F.concat(F.lit(',"actions":[{"action_id":"fav","item":"'), (C("id") % 5).cast("string"), F.lit('"}]'))).otherwise(""),
        F.when(C("id") % 11 == 0, F.concat(F.lit(',"start":{"entry":"icon","loading_time":'), (C("id") % 100).cast("string"), F.lit("}"))).otherwise(""))
    logs = t.spark.sql(RAW["ods_z_log"], events=t.events)
    whole = F.concat(F.expr("substring_index(log, ',\"ts\":', 1)"), more, F.lit(',"ts":'), F.expr("substring_index(log, ',\"ts\":', -1)"))
    return logs.select(F.when(C("id") % 20 == 0, F.substring("log", 1, 30)).otherwise(whole).alias("log"))


@query
def log_splitter(t):
    detail = F.coalesce("log", C("err.error_code").cast("string"), "display.item", "action.item", C("start.loading_time").cast("string"), F.when(C("kind") == "page", C("common.is_new")))
    rows = live.log_splitter(_full_logs(t), buckets=t.buckets("events")).select("kind", "ts", detail.alias("detail"), C("common.is_new").alias("is_new"))
    path = f"{work_dir(t.spark)}/kinds-{uuid.uuid4().hex}"
    run_to_end(rows, write=live.kind_log(path))
    return t.spark.read.schema(rows.schema).parquet(path).select("kind", "ts", "detail", "is_new")


@query
def dim_router(t):
    """Customers and parts in two batches; between them customers get another table and parts are no longer routed. Deletes take rows away."""
    def changes(df, table, key, name, extra):
        row = F.create_map(F.lit("id"), C(key).cast("string"), F.lit("name"), C(name), F.lit("extra"), C(extra))
        twice = df.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("version")).where((C("version") == 0) | (C(key) % 2 == 0))
        gone = (C("version") == 1) & (C(key) % 10 == 0)
        return twice.select("version", F.when(gone, "d").when(C("version") == 1, "u").otherwise("c").alias("op"), F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"),
                            F.create_map(F.lit("table"), F.lit(table)).alias("source"), (C(key) * 10 + C("version")).alias("ts_ms"))
    data = changes(t.static("customer"), "customer", "c_custkey", "c_name", "c_mktsegment").unionByName(changes(t.static("part"), "part", "p_partkey", "p_name", "p_brand"))

    def config(op, ts, *rows):
        cells = lambda r: F.create_map(*[x for k, v in zip(("source_table", "sink_table", "sink_row_key", "sink_columns"), r, strict=True) for x in (F.lit(k), F.lit(v))])
        none = F.lit(None).cast("map<string,string>")
        one = t.spark.range(1).select(F.explode(F.array(*map(cells, rows))).alias("row"))
        return one.select(F.lit(op).alias("op"), (C("row") if op == "d" else none).alias("before"), (none if op == "d" else C("row")).alias("after"), none.alias("source"), F.lit(ts).cast("long").alias("ts_ms"))
    first = config("r", 1, ("customer", "dim_user", "id", "id,name"), ("part", "dim_sku", "id", None))
    second = config("u", 2, ("customer", "dim_buyer", "id", "id,extra")).unionByName(config("d", 2, ("part", "dim_sku", "id", None)))
    records = t.in_turn(*(live.dim_router(data.where(C("version") == v).drop("version"), c) for v, c in ((0, first), (1, second))))
    router = st.DimRouter(t.spark, f"{work_dir(t.spark)}/router-{uuid.uuid4().hex}")
    run_to_end(records, write=router.write)
    pairs = F.transform(F.array_sort(F.map_entries("values")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return router.rows.read().select("sink_table", "row_key", F.array_join(pairs, ";").alias("cells"))


@query
def comment_fact(t):
    """Comments, a third of them changed and a seventh deleted later on."""
    comments = t.conversations.withColumn("at", F.timestamp_seconds(C("conv_id") * 100 + C("turn")))
    key, row = C("conv_id") + C("turn"), {"id": F.concat_ws("-", "conv_id", "turn"), "user_id": C("conv_id"), "sku_id": C("turn"), "appraise": 1201 + C("turn") % 4, "comment_txt": C("text")}
    new = _changes(comments, "comment_info", "c", "at", row)
    changed = _changes(comments.where(key % 3 == 0).withColumn("at", C("at") + F.expr("INTERVAL 1 HOUR")), "comment_info", "u", "at", {**row, "comment_txt": F.concat("text", F.lit(" (changed)"))}, row)
    gone = _changes(comments.where(key % 7 == 0).withColumn("at", C("at") + F.expr("INTERVAL 2 HOURS")), "comment_info", "d", "at", row, row)
    cdc = new.unionByName(changed).unionByName(gone)
    return _texts(run_to_end(live.comment_fact(cdc, _dim(t, "ods_base_dic")), keys=["id"], order=["event_time"]))


@query
def cart_add_fact(t):
    return _texts(run_to_end(live.cart_add_fact(cart_changes(t)), keys=["id"], order=["event_time"]))


def _detail_fact(t):
    """The detail job's own stream; a tenth of the details is deleted after a day."""
    t = t.orders_and_lines()
    late = detail_changes(t).where(C("after")["sku_id"].cast("long") % 10 == 0)
    gone = late.select(F.lit("d").alias("op"), C("after").alias("before"), F.lit(None).cast("map<string,string>").alias("after"), "source", (C("ts_ms") + 86_400_000).alias("ts_ms"))
    cdc = order_changes(t).unionByName(detail_changes(t)).unionByName(gone).unionByName(side_changes(t))
    return live.order_detail_fact(cdc, *NEAR, DAY, *SIDE, t.late_times)


@query
def order_detail_fact(t):
    return _texts(run_to_end(_detail_fact(t), keys=["id"], order=["detail_time"]))


def _with_details(t):
    """What the detail job has written, as the next job's source beside the orders."""
    with st.bounded(t.spark):
        details = run_to_end(_detail_fact(t), keys=["id"], order=["detail_time"])
    t = t.in_time_order({"orders": (t.stored("orders"), "o_orderdate"), "details": (details, "detail_time")})
    if "details" not in vars(t):
        t.details = t.again(details)
    return t


@query
def order_cancel_fact(t):
    t = _with_details(t)
    return _texts(run_to_end(live.order_cancel_fact(t.details, order_changes(t), *NEAR, DAY), keys=["id"], order=["detail_time"]))


@query
def pay_success_fact(t):
    t = _with_details(t)
    pay = _changes(t.orders, "payment_info", "c", "o_orderdate", {"order_id": C("o_orderkey"), "user_id": C("o_custkey"), "payment_type": 1101 + C("o_orderkey") % 4,
                                                                 "callback_time": F.date_format("o_orderdate", "yyyy-MM-dd"), "payment_status": F.when(C("o_orderstatus") == "O", "1601").otherwise("1602")})
    return _texts(run_to_end(live.pay_success_fact(t.details, pay, _dim(t, "ods_base_dic"), "-30 days", "5 seconds", DAY), keys=["order_detail_id"], order=["pay_time"]))


@query
def refund_fact(t):
    return _texts(run_to_end(live.refund_fact(order_changes(t).unionByName(refund_changes(t)), _dim(t, "ods_base_dic"), *NEAR, DAY), keys=["id"], order=["refund_time"]))


@query
def refund_paid_fact(t):
    return _texts(run_to_end(live.refund_paid_fact(order_changes(t).unionByName(refund_changes(t)), _dim(t, "ods_base_dic"), *NEAR, DAY), keys=["id"], order=["pay_time"]))


@query
def search_keywords(t):
    doc = F.struct(F.struct(F.lit("m").alias("mid")).alias("common"), F.struct(F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"), C("text").alias("item")).alias("page"),
                   (C("conv_id") * 1000).alias("ts"))
    return run_to_end(live.search_keywords(t.conversations.select(F.to_json(doc).alias("log"))))


@query
def cart_unique_users(t):
    return run_to_end(live.cart_unique_users(live.cart_add_fact(cart_changes(t)), "7 days", buckets=t.buckets("lineitem")))


def _versions(t):
    """Orders as detail rows that come twice, every third with another amount the second time."""
    total = money("o_totalprice")
    kinds = [F.struct(F.lit(v).alias("version"), F.when(C("o_orderkey") % 3 == 0, total + add).otherwise(total).cast("decimal(16,2)").alias("split_total_amount")) for v, add in ((1, 0), (2, 10))]
    rows = t.orders.select("o_orderkey", "o_custkey", C("o_orderdate").alias("event_time"), F.inline(F.array(*kinds)))
    return rows.select(C("o_orderkey").cast("string").alias("id"), C("o_orderkey").alias("order_id"), (C("o_custkey") % 25).cast("string").alias("province_id"), C("o_custkey").cast("string").alias("sku_id"),
                       C("split_total_amount").alias("split_original_amount"), F.lit(0).cast("decimal(16,2)").alias("split_activity_amount"), F.lit(1).cast("decimal(16,2)").alias("split_coupon_amount"),
                       "split_total_amount", "event_time", "version")


@query
def province_orders(t):
    return run_to_end(live.province_orders(_versions(t), _dim(t, "ods_base_province").withColumnRenamed("name", "province_name"), "7 days", DAY, ["version"], buckets=t.buckets("orders", 2)))


@query
def sku_orders(t):
    dims = {"sku": _dim(t, "ods_sku_info"), "spu": _dim(t, "ods_spu_info"), "trademark": _dim(t, "ods_base_trademark"), "category3": _dim(t, "ods_base_category3"),
            "category2": _dim(t, "ods_base_category2"), "category1": _dim(t, "ods_base_category1")}
    return run_to_end(live.sku_orders(_versions(t), dims, "7 days", DAY, ["version"], buckets=t.buckets("orders", 2)))


@query
def home_detail_visitors(t):
    return run_to_end(live.home_detail_visitors(log_stream(t), "1 hour", buckets=t.buckets("events")))


@query
def page_view_metrics(t):
    return run_to_end(live.page_view_metrics(log_stream(t), "1 hour", buckets=t.buckets("events")))


@query
def login_users(t):
    return run_to_end(live.login_users(log_stream(t), "1 hour", buckets=t.buckets("events")))


@query
def row_store(t):
    """Customers, changed twice over; a tenth is deleted in the end."""
    row = {"id": C("c_custkey"), "name": C("c_name")}
    at = lambda n: t.customer.withColumn("at", F.timestamp_seconds(C("c_custkey") + n))
    cdc = _changes(at(0), "user_info", "c", "at", row)
    cdc = cdc.unionByName(_changes(at(10).where("c_custkey % 2 = 0"), "user_info", "u", "at", {**row, "name": C("c_mktsegment")}, row))
    cdc = cdc.unionByName(_changes(at(20).where("c_custkey % 10 = 0"), "user_info", "d", "at", row, row))
    rows = run_to_end(live.row_store(cdc), keys=["table", "row_id"], order=["ts"])
    return rows.select("id", "op", "table", C("values")["name"].alias("name"), "ts")


@query
def json_passthrough(t):
    """Rows as labelled JSON loads."""
    path = f"{work_dir(t.spark)}/json-{uuid.uuid4().hex}"
    run_to_end(t.nation, write=st.json_batches(path))
    return t.spark.read.schema("value string").text(path).select("value")
