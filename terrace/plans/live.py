"""Real-time jobs as compositions of the streaming operators.

Input is one change-record topic (streaming.cdc.CDC_SCHEMA) and one log topic (column `log`, JSON text); both are plain
streaming frames, so any source works. Facts are upserts, and deletes where `_deleted` is true, of tables keyed by their id
(sinks.KeyedTable, or run_to_end with keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import streaming as st
from terrace.functions import money
from terrace.plans.shop import LOG_SCHEMA
from terrace.streaming.sinks import DimRouter
from terrace.streaming.state import BUCKETS

# Status and dictionary codes.
CANCELLED, REFUNDING, REFUNDED, PAID, REFUND_DONE = "1003", "1005", "1006", "1602", "0705"
LOG_FULL = (LOG_SCHEMA + ", displays array<struct<item:string,item_type:string,pos_id:string,pos_seq:string>>, "
            "actions array<struct<action_id:string,item:string,item_type:string,ts:bigint>>, err struct<error_code:bigint,msg:string>, start struct<entry:string,loading_time:bigint>")
MONEY = "decimal(16,2)"
DELAY = "5 seconds"


def log_splitter(log: DataFrame, delay: str = DELAY, ttl: str | None = "400 days", buckets: int = BUCKETS) -> DataFrame:
    """The log as tagged rows from one pass: err, start, display, action and page with the new-visitor flag repaired, and dirty with the
    text (`log`) of records that can't be parsed or have no event time. The flag of a record without a device stays as it is."""
    rows = st.parse_marked(log, "log", LOG_FULL)
    good = F.col("doc.ts").isNotNull()
    rows = rows.select(F.when(good, F.col("doc")).alias("doc"), F.when(~good, F.col("log")).alias("log"), F.col("doc.common.mid").alias("mid"),
                       F.col("doc.common.is_new").alias("is_new"), F.timestamp_millis("doc.ts").alias("ts"))
    fixed = st.repair_is_new(rows, "mid", "is_new", "ts", delay, ttl, buckets=buckets).drop("ts")
    doc = F.col("doc")
    common = F.when(doc["common"].isNotNull(), doc["common"].withField("is_new", F.col("is_new")))
    names = [f.name for f in T.StructType.fromDDL(LOG_FULL)]
    return st.split_log(fixed.select("log", *(common.alias(n) if n == "common" else doc[n].alias(n) for n in names)), dirty="log")


def kind_log(path: str):
    """foreachBatch writer of tagged rows: a folder per kind and micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch_id={batch_id}")
    return write


def page_rows(log: DataFrame) -> DataFrame:
    """Page views as flat rows with an event time."""
    good, _ = st.parse_or_dirty(log, "log", LOG_SCHEMA)
    return good.where("doc.page is not null").select("doc.common.*", "doc.page.*", F.timestamp_millis("doc.ts").alias("event_time"))


def dim_router(cdc: DataFrame, config: DataFrame) -> DataFrame:
    """Change records and records of the routing configuration as one stream for sinks.DimRouter.

    config: change records whose row is source_table, sink_table, sink_row_key and sink_columns.
    """
    return cdc.select(F.lit("data").alias("stream"), *CDC_COLUMNS).unionByName(config.select(F.lit("config").alias("stream"), *CDC_COLUMNS))


CDC_COLUMNS = ("op", "before", "after", "source", "ts_ms")


def comment_fact(cdc: DataFrame, dictionary: DataFrame) -> DataFrame:
    rows = st.cdc_select(cdc, "comment_info", ["r", "c", "u", "d"], {"id": "id string", "user_id": "user_id string", "sku_id": "sku_id string", "appraise": "appraise string",
                                                                    "comment_txt": "comment_txt string"})
    return st.lookup(rows, dictionary, ("appraise", "dic_code"), {"dic_name": "appraise_name"}, how="inner")


def cart_add_fact(cdc: DataFrame) -> DataFrame:
    cart = st.cdc_delta(cdc.where(F.col("source")["table"] == "cart_info"), "sku_num")
    return cart.select(F.col("after")["id"].alias("id"), F.col("after")["user_id"].alias("user_id"), F.col("after")["sku_id"].alias("sku_id"),
                       F.col("delta").cast("int").alias("sku_num"), F.timestamp_millis("ts_ms").alias("event_time"))


def order_rows(cdc: DataFrame, ops: Sequence[str], status: str | None, delay: str, extra: Mapping[str, str] | None = None, late: int = 0) -> DataFrame:
    rows = st.cdc_select(cdc, "order_info", ops, {"id": "header_id string", "user_id": "user_id string", "province_id": "province_id string", **(extra or {})},
                         {"order_status": [status]} if status else None)
    return rows.withColumnRenamed("event_time", "header_time").transform(st.moved, "header_time", late).transform(st.watermark, "header_time", delay)


DETAIL_AMOUNTS = {"split_activity_amount": f"split_activity_amount {MONEY}", "split_coupon_amount": f"split_coupon_amount {MONEY}", "split_total_amount": f"split_total_amount {MONEY}"}
SAVED = ["r", "c", "u"]


def detail_rows(cdc: DataFrame, delay: str) -> DataFrame:
    rows = st.cdc_select(cdc, "order_detail", SAVED, {"id": "id string", "order_id": "order_id string", "sku_id": "sku_id string", "sku_name": "sku_name string",
                                                     "create_time": "create_time string", "sku_num": "sku_num bigint", "order_price": f"order_price {MONEY}", **DETAIL_AMOUNTS})
    rows = rows.withColumns({"split_original_amount": money(F.col("sku_num") * F.col("order_price")), "date_id": F.substring("create_time", 1, 10)}).drop("order_price")
    return rows.withColumnRenamed("event_time", "detail_time").transform(st.watermark, "detail_time", delay)


def with_deletes(rows: DataFrame, cdc: DataFrame, table: str, time: str) -> DataFrame:
    """Rows of a fact keyed by the id of `table`, and that table's deletes, which meet no join on their way."""
    gone = st.cdc_select(cdc, table, ["d"], {"id": "id string"}).withColumnRenamed("event_time", time)
    return rows.unionByName(gone, allowMissingColumns=True)


def order_detail_fact(cdc: DataFrame, lo: str = "-1 hour", hi: str = "1 hour", delay: str = DELAY, side_lo: str = "-1 hour", side_hi: str = "1 hour",
                      late: Mapping[str, int] | None = None) -> DataFrame:
    """Details with user, province, activity and coupon. A detail whose activity or coupon comes within the side range is written once that range has
    passed; one that comes later than it is not joined, so the ranges say what the table may miss. In a replay orders, activities and coupons may come
    some days later (or, below 0, earlier) than details of their time; `late` has these days for header_time, act_time and cou_time."""
    days = (late or {}).get
    activity = st.cdc_select(cdc, "order_detail_activity", SAVED, {"order_detail_id": "act_detail_id string", "activity_id": "activity_id string",
                                                                  "activity_rule_id": "activity_rule_id string"}).withColumnRenamed("event_time", "act_time")
    coupon = st.cdc_select(cdc, "order_detail_coupon", SAVED, {"order_detail_id": "cou_detail_id string", "coupon_id": "coupon_id string"}).withColumnRenamed("event_time", "cou_time")
    rows = st.order_detail_stream(
        detail_rows(cdc, delay), order_rows(cdc, SAVED, None, delay, late=days("header_time", 0)),
        activity.transform(st.moved, "act_time", days("act_time", 0)).transform(st.watermark, "act_time", delay),
        coupon.transform(st.moved, "cou_time", days("cou_time", 0)).transform(st.watermark, "cou_time", delay), lo, hi, side_lo, side_hi, late)
    return with_deletes(rows.drop("header_id", "act_detail_id", "cou_detail_id"), cdc, "order_detail", "detail_time")


def order_cancel_fact(detail: DataFrame, cdc: DataFrame, lo: str = "-1 day", hi: str = "1 day", delay: str = DELAY) -> DataFrame:
    """Rows of the detail fact (with its detail_time) of orders that were cancelled, with the time and day of that."""
    cancelled = order_rows(cdc, SAVED, CANCELLED, delay, {"operate_time": "cancel_time string"}).select("header_id", "cancel_time", "header_time")
    rows = st.interval_join(st.watermark(detail, "detail_time", delay), cancelled, {"order_id": "header_id"}, "detail_time", "header_time", lo, hi)
    return rows.withColumn("date_id", F.substring("cancel_time", 1, 10)).drop("header_id", "header_time", "create_time")


def pay_success_fact(detail: DataFrame, cdc: DataFrame, dictionary: DataFrame, lo: str = "-30 minutes", hi: str = "5 seconds", delay: str = DELAY) -> DataFrame:
    """Rows of the detail fact of orders that were paid for, with the payment's user, type and time."""
    paid = st.cdc_select(cdc, "payment_info", SAVED, {"order_id": "pay_order_id string", "payment_type": "payment_type_code string",
                                                     "callback_time": "callback_time string"}, {"payment_status": [PAID]})
    paid = paid.withColumnRenamed("event_time", "pay_time").transform(st.watermark, "pay_time", delay)
    rows = st.interval_join(st.watermark(detail, "detail_time", delay), paid, {"order_id": "pay_order_id"}, "detail_time", "pay_time", lo, hi)
    rows = st.lookup(rows.drop("pay_order_id", "detail_time", "create_time", "date_id"), dictionary, ("payment_type_code", "dic_code"), {"dic_name": "payment_type_name"}, how="inner")
    return rows.withColumnsRenamed({"id": "order_detail_id", "split_total_amount": "split_payment_amount"})


def refund_fact(cdc: DataFrame, dictionary: DataFrame, lo: str = "-1 day", hi: str = "1 day", delay: str = DELAY) -> DataFrame:
    refund = st.cdc_select(cdc, "order_refund_info", SAVED, {
        "id": "id string", "user_id": "user_id string", "order_id": "order_id string", "sku_id": "sku_id string", "create_time": "create_time string", "refund_type": "refund_type_code string",
        "refund_reason_type": "refund_reason_type_code string", "refund_reason_txt": "refund_reason_txt string", "refund_num": "refund_num bigint", "refund_amount": f"refund_amount {MONEY}"})
    refund = refund.withColumnRenamed("event_time", "refund_time").transform(st.watermark, "refund_time", delay)
    orders = order_rows(cdc, ["u"], REFUNDING, delay).drop("user_id")
    names = [(dictionary, ("refund_type_code", "dic_code"), {"dic_name": "refund_type_name"}), (dictionary, ("refund_reason_type_code", "dic_code"), {"dic_name": "refund_reason_type_name"})]
    rows = st.enrich_chain(st.interval_join(refund, orders, {"order_id": "header_id"}, "refund_time", "header_time", lo, hi), names, how="inner")
    return with_deletes(rows.withColumn("date_id", F.substring("create_time", 1, 10)).drop("header_id", "header_time"), cdc, "order_refund_info", "refund_time")


def refund_paid_fact(cdc: DataFrame, dictionary: DataFrame, lo: str = "-1 day", hi: str = "1 day", delay: str = DELAY) -> DataFrame:
    pay = st.cdc_select(cdc, "refund_payment", ["u"], {"id": "id string", "order_id": "order_id string", "sku_id": "sku_id string", "payment_type": "payment_type_code string",
                                                      "total_amount": f"refund_amount {MONEY}"}, {"refund_status": [PAID]}, changed="refund_status")
    refund = st.cdc_select(cdc, "order_refund_info", ["u"], {"order_id": "refund_order_id string", "sku_id": "refund_sku_id string", "refund_num": "refund_num bigint"},
                           {"refund_status": [REFUND_DONE]}, changed="refund_status")
    rows = st.refund_paid_stream(
        pay.withColumnRenamed("event_time", "pay_time").transform(st.watermark, "pay_time", delay), refund.withColumnRenamed("event_time", "refund_time").transform(st.watermark, "refund_time", delay),
        order_rows(cdc, ["u"], REFUNDED, delay), lo, hi, [])
    return st.lookup(rows, dictionary, ("payment_type_code", "dic_code"), {"dic_name": "payment_type_name"}, how="inner").drop("header_id", "refund_order_id", "refund_sku_id")


def search_keywords(log: DataFrame, size: str = "3 seconds", watermark: str = "3 seconds") -> DataFrame:
    searched = page_rows(log).where("last_page_id = 'search' and item_type = 'keyword' and item is not null")
    return st.keyword_counts(searched, "item", "event_time", size, watermark)


def cart_unique_users(cart: DataFrame, size: str = "5 seconds", delay: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    return st.unique_window(cart, "event_time", ["user_id"], size, delay, name="cart_add_uu_ct", buckets=buckets)


def province_orders(detail: DataFrame, provinces: DataFrame, size: str = "10 seconds", delay: str = DELAY, order: Sequence[str] = (), ttl: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """Distinct orders and net amount per province and window, as JSON rows."""
    clean = st.retract_dedup(detail.select("id", "order_id", "province_id", "split_total_amount", "event_time", *order), "id", ["split_total_amount"], "event_time", delay,
                             ttl, ["event_time", *order], buckets)
    sums = st.distinct_window(clean, "event_time", ["province_id"], "order_id", "split_total_amount", size, None)
    return st.to_snake_json(st.lookup(sums, provinces, ("province_id", "id"), {"province_name": "province_name"}))


SKU_SUMS = {"original_amount": "split_original_amount", "activity_reduce_amount": "split_activity_amount", "coupon_reduce_amount": "split_coupon_amount", "order_amount": "split_total_amount"}


def sku_orders(detail: DataFrame, dims: Mapping[str, DataFrame], size: str = "5 seconds", delay: str = DELAY, order: Sequence[str] = (), ttl: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """Four amounts per product and window with brand and category names, as JSON rows."""
    clean = st.retract_dedup(detail.select("id", "sku_id", *SKU_SUMS.values(), "event_time", *order), "id", list(SKU_SUMS.values()), "event_time", delay, ttl, ["event_time", *order], buckets)
    sums = st.amount_window(clean, "event_time", ["sku_id"], SKU_SUMS, size)
    steps = [(dims["sku"], ("sku_id", "id"), {"sku_name": "sku_name", "spu_id": "spu_id", "category3_id": "category3_id", "tm_id": "tm_id"}),
             (dims["spu"], ("spu_id", "id"), {"spu_name": "spu_name"}), (dims["trademark"], ("tm_id", "id"), {"tm_name": "trademark_name"}),
             (dims["category3"], ("category3_id", "id"), {"name": "category3_name", "category2_id": "category2_id"}),
             (dims["category2"], ("category2_id", "id"), {"name": "category2_name", "category1_id": "category1_id"}),
             (dims["category1"], ("category1_id", "id"), {"name": "category1_name"})]
    return st.to_snake_json(st.enrich_chain(sums, steps).withColumnRenamed("tm_id", "trademark_id"))


def home_detail_visitors(log: DataFrame, size: str = "5 seconds", delay: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    flags = {"home_uv_ct": F.col("page_id") == "home", "good_detail_uv_ct": F.col("page_id") == "good_detail"}
    return st.to_snake_json(st.unique_window(page_rows(log), "event_time", ["mid"], size, delay, flags=flags, buckets=buckets))


def page_view_metrics(log: DataFrame, size: str = "10 seconds", delay: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    return st.to_snake_json(st.page_view_window(page_rows(log), "event_time", "mid", ["vc", "ch", "ar", "is_new"], "during_time", "last_page_id", size, delay, buckets=buckets))


def login_users(log: DataFrame, size: str = "1 second", delay: str = "0 seconds", ttl: str = "400 days", buckets: int = BUCKETS) -> DataFrame:
    """Users logging in: a known user coming from the login page or opening the app."""
    logins = page_rows(log).where("coalesce(uid, '') <> '' and (last_page_id = 'login' or coalesce(last_page_id, '') = '')").select("uid", "event_time")
    return st.to_snake_json(st.login_window(logins, "event_time", "uid", size, delay, ttl=ttl, buckets=buckets))


def row_store(cdc: DataFrame) -> DataFrame:
    """Rows of a keyed row store: table and row_id are the key, ts the version; a delete takes the row away."""
    flat = st.cdc_envelope(cdc)
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return flat.select("table", row["id"].alias("row_id"), "id", "op", row.alias("values"), "ts", (F.col("op") == "d").alias("_deleted"))
