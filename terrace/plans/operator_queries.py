"""One query per batch operator, bound to the given tables. Keys are listed in QUERIES."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import operators as op
from terrace.functions import (epoch_normalise, md5_bucket, money, pii_hash, pii_mask, rule_text, second_text, sum_money,
                               weighted_avg)
from terrace.functions.text import initial_mask
from terrace.session import tune, work_dir
from terrace.sources import load, write_partitions

ORDER_DAY = date(1998, 6, 30)
EVENT_DAY = date(2024, 1, 20)
QUERIES = {}


class Tables:
    """Attribute access to the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


def _lines(t: Tables) -> DataFrame:
    """Lines with header, customer and product columns."""
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .withColumn("day", F.to_date("o_orderdate")))


def _daily_orders(t: Tables) -> DataFrame:
    return (t.orders.withColumn("dt", F.to_date("o_orderdate")).groupBy("o_custkey", "dt")
            .agg(F.count(F.lit(1)).alias("order_count"), sum_money("o_totalprice", "order_amount")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, buyers and amount per brand for the last 1, 7 and 30 days."""
    t = Tables(spark, sf_dir)
    recent = op.rollups.fan_out_recent_days(_lines(t), "o_orderdate", ORDER_DAY)
    # (n, brand, buyer) first: buyers can then be counted without a distinct expansion over all lines.
    per_user = recent.groupBy("recent_days", "p_brand", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), sum_money("l_extendedprice", "amount"))
    return per_user.groupBy("recent_days", F.col("p_brand").alias("brand")).agg(
        F.sum("n").alias("order_count"), F.count("o_custkey").alias("order_user_count"),
        F.sum("amount").cast("decimal(18,2)").alias("order_amount"))


QUERIES["brand_recent_days"] = flagship


@query
def recent_days_rollup(t):
    return op.recent_days_rollup(t.orders, "o_orderdate", ORDER_DAY, [1, 7, 30], ["o_orderpriority"],
                                 [F.count(F.lit(1)).alias("order_count"), sum_money("o_totalprice", "order_amount")])


@query
def daily_rollup(t):
    lines = _lines(t)
    return op.daily_rollup(lines, ["o_custkey"], "day", [
        F.count_distinct("o_orderkey").alias("order_count"), F.sum("l_quantity").cast("bigint").alias("order_num"),
        sum_money("l_extendedprice", "amount")])


@query
def nday_wide(t):
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.withColumns({"amount": money("o_totalprice"), "orders": F.lit(1).cast("bigint")})
    wide = op.nday_wide(orders, "o_orderdate", ORDER_DAY, ["c_nationkey"], {"order_count": "orders", "order_amount": "amount"})
    return wide.withColumns({c: F.col(c).cast("decimal(18,2)") for c in wide.columns if "amount" in c})


@query
def dedup_then_sum(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("amount", money("o_totalprice"))
    return op.dedup_then_sum(lines, "o_orderkey", "amount", ["o_orderpriority"])


def _to_date_sides(t):
    daily = _daily_orders(t)
    old = op.to_date_rebuild(daily.where(F.col("dt") < F.lit(ORDER_DAY)), "o_custkey", "dt", ["order_count", "order_amount"])
    return old.withColumn("order_amount", F.col("order_amount").cast("decimal(18,2)")), daily.where(F.col("dt") == F.lit(ORDER_DAY))


@query
def to_date_merge_outer(t):
    return op.to_date_merge_outer(*_to_date_sides(t), "o_custkey", ORDER_DAY, ["order_count", "order_amount"])


@query
def to_date_merge_union(t):
    return op.to_date_merge_union(*_to_date_sides(t), "o_custkey", ORDER_DAY, ["order_count", "order_amount"])


@query
def to_date_rebuild(t):
    daily = _daily_orders(t).where(F.col("dt") <= F.lit(ORDER_DAY))
    out = op.to_date_rebuild(daily, "o_custkey", "dt", ["order_count", "order_amount"])
    return out.withColumn("order_amount", F.col("order_amount").cast("decimal(18,2)"))


@query
def session_traffic_stats(t):
    events = t.events.withColumns({"day": F.to_date("ts"), "stay": (F.col("value") * 100).cast("bigint")})
    channel = F.min_by("event_type", F.struct("ts", "event_id"))
    return op.session_traffic_stats(events, ["user_id"], "user_id", channel, "stay", "day", EVENT_DAY)


@query
def page_path(t):
    events = t.events.withColumn("day", F.to_date("ts"))
    return op.page_path(events, ["user_id", "day"], "event_type", "ts", "event_id")


@query
def page_path_hot_sessions(t):
    """The same report with pieces of one second, as for sessions that are too large for one task by the hour."""
    events = t.events.withColumn("day", F.to_date("ts"))
    return op.page_path(events, ["user_id", "day"], "event_type", "ts", "event_id", piece_seconds=1)


def _purchases(t):
    return t.events.where("event_type = 'purchase'")


@query
def churn_and_return(t):
    return op.churn_and_return(_purchases(t), "user_id", "ts", date(2024, 1, 24))


@query
def retention_cohorts(t):
    return op.retention_cohorts(t.events, "user_id", "ts", date(2024, 1, 8))


@query
def new_active_users(t):
    return op.new_active_users(t.events, "user_id", "ts", EVENT_DAY)


@query
def funnel(t):
    steps = {"home_count": "view", "good_detail_count": "click", "cart_count": "signup", "order_count": "purchase"}
    return op.funnel(t.events, "user_id", "event_type", steps, "ts", EVENT_DAY)


@query
def new_order_users(t):
    return op.new_order_users(t.orders, "o_custkey", "o_orderdate", date(1995, 3, 31))


def _streak(method):
    def run(spark, sf_dir):
        return op.consecutive_days(_purchases(Tables(spark, sf_dir)), "user_id", "ts", EVENT_DAY, method=method)
    return run


for _method in ("mask", "lead", "island", "loose"):
    QUERIES[f"consecutive_days_{_method}"] = _streak(_method)


@query
def repeat_purchase_rate(t):
    return op.repeat_purchase_rate(_lines(t), "o_custkey", ["p_type"], "o_orderdate", ORDER_DAY)


@query
def stats_by_brand(t):
    return op.stats_by_dim(_lines(t), ["p_brand"], "o_custkey", "o_orderdate", ORDER_DAY)


@query
def stats_by_type_brand(t):
    return op.stats_by_dim(_lines(t), ["p_type", "p_brand"], "o_custkey", "o_orderdate", ORDER_DAY)


@query
def topk_with_ties(t):
    sold = (t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("sold"))
            .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .select("p_brand", "p_partkey", "sold"))
    return op.topk_with_ties(sold, ["p_brand"], "sold", 3)


@query
def avg_interval_seconds(t):
    lines = _lines(t).where("l_shipdate >= o_orderdate")
    return op.avg_interval_seconds(lines, "o_orderdate", "l_shipdate", ["o_orderpriority"])


@query
def accumulating_snapshot(t):
    shipped = (t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
               .where("l_shipdate >= o_orderdate").groupBy(F.col("o_orderkey").alias("order_id"))
               .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    base = t.orders.select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate",
                           F.lit(None).cast("timestamp").alias("pay_time"), F.lit(None).cast("timestamp").alias("finish_time"))
    day = F.lit(ORDER_DAY)
    before, today = base.where(F.to_date("o_orderdate") < day), base.where(F.to_date("o_orderdate") == day)
    out = op.accumulating_snapshot(before, today.drop("pay_time", "finish_time"),
                                   [(shipped, {"first_ship": "pay_time", "last_ship": "finish_time"})], "order_id", "finish_time")
    return out.withColumns({c: second_text(F.col(c)) for c in ("o_orderdate", "pay_time", "finish_time")})


def _customer_history(t):
    users = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                              F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return op.scd2_init(users.where("id % 5 <> 1"), F.lit("1998-06-01")), users


@query
def scd2_merge(t):
    history, users = _customer_history(t)
    # A third of the users come in with today's rows; half of those really changed.
    changes = users.where("id % 3 = 0").withColumn("segment", F.when(F.expr("id % 2 = 0"), F.lit("MOVED")).otherwise(F.col("segment")))
    return op.scd2_merge(history, changes, "id", ["name", "segment", "nation"], ORDER_DAY)


@query
def star_flatten(t):
    flat = op.star_flatten(t.supplier, [
        (t.nation, "s_nationkey", "n_nationkey", {"n_name": "nation_name", "n_regionkey": "region_key"}),
        (t.region, "region_key", "r_regionkey", {"r_name": "region_name"})])
    return flat.select("s_suppkey", "s_name", "nation_name", "region_key", "region_name")


@query
def fold_attributes(t):
    attributes = t.part.select("p_partkey", F.inline(F.array(
        F.struct(F.lit("brand").alias("attr"), F.col("p_brand").alias("value")),
        F.struct(F.lit("type").alias("attr"), F.col("p_type").alias("value")),
        F.struct(F.lit("size").alias("attr"), F.col("p_size").cast("string").alias("value")))))
    folded = op.dims.fold_set(attributes, "p_partkey", {"attr": F.col("attr"), "value": F.col("value")}, "attrs")
    return folded.select("p_partkey", F.array_join(F.transform("attrs", lambda a: F.concat(a["attr"], F.lit("="), a["value"])), ";").alias("attrs"))


STATUS_NAMES = {"O": "open", "F": "finished"}


def _dictionary(spark, parent, names):
    rows = ", ".join(f"('{code}', '{name}', '{parent}')" for code, name in names.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS d(dic_code, dic_name, parent_code)")


@query
def dict_decode(t):
    dictionary = _dictionary(t.spark, "10", STATUS_NAMES)
    return op.dict_decode(t.orders, dictionary, "o_orderstatus", "status_name", "10").select("o_orderkey", "o_orderstatus", "status_name")


@query
def rule_text_query(t):
    templates = {"ECONOMY": "size {p_size} for {price}", "SMALL": "only {price}"}
    return (t.part.withColumn("price", money("p_retailprice"))
            .select("p_partkey", rule_text(F.col("p_type"), templates).alias("rule")))


QUERIES["rule_text"] = QUERIES.pop("rule_text_query")


@query
def pii_masks(t):
    phone = F.concat(F.lit("13"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    phone = F.when(F.expr("c_custkey % 7 = 0"), F.lit("999")).otherwise(phone)
    email = F.concat(F.lower("c_name"), F.when(F.expr("c_custkey % 11 = 0"), F.lit("")).otherwise(F.lit("@")), F.lower("c_mktsegment"), F.lit(".com"))
    email = F.regexp_replace(email, "#", "_")
    from terrace.functions.text import PHONE_STRICT
    return t.customer.select(
        "c_custkey", initial_mask(F.col("c_name")).alias("name"), pii_mask(phone, "phone").alias("phone"),
        pii_mask(phone, "phone_tail").alias("phone_tail"), pii_mask(email, "email").alias("email"),
        pii_mask(email, "email_tail").alias("email_tail"), pii_hash(phone, PHONE_STRICT).alias("phone_hash"),
        pii_hash(F.col("c_name")).alias("name_hash"))


@query
def parse_event_json(t):
    parsed = op.parse_event_json(t.events, "props", "k bigint")
    return parsed.groupBy("event_type").agg(F.sum("doc.k").alias("k_sum"), F.count("doc.k").alias("k_count"))


@query
def first_per_group(t):
    events = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", "event_type")
    first = op.first_per_group(events, ["user_id", "day"], ["ts", "event_id"])
    return first.select("user_id", "day", "event_id", "event_type")


@query
def register_enrich(t):
    users = t.events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"))
    views = op.first_per_group(t.events.where("event_type = 'view'").select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"])
    return op.register_enrich(users, views.select("user_id", F.col("event_id").alias("view_id"), money("value").cast("decimal(18,2)").alias("view_value")), "user_id")


@query
def detail_enrich(t):
    wide = op.detail_enrich(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", money("l_extendedprice").alias("amount"), money("l_tax").alias("tax")),
        (t.orders, "l_orderkey", "o_orderkey", {"o_custkey": "user_id", "o_orderdate": "order_time"}, "left"),
        (t.customer, "user_id", "c_custkey", {"c_mktsegment": "segment", "c_nationkey": "province_id"}, "left"))
    return wide.groupBy("segment", "province_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(18,2)").alias("amount"),
        F.max(second_text(F.col("order_time"))).alias("last_order"))


@query
def snapshot_filter(t):
    return op.snapshot_filter(t.orders, F.col("o_orderstatus") == "O", "1998-06-30").select("o_orderkey", "o_custkey", "dt")


@query
def lifecycle_facts_allow(t):
    return op.lifecycle_facts(t.orders, "o_orderstatus", allow=["F"]).select("o_orderkey", "o_orderstatus")


@query
def lifecycle_facts_deny(t):
    return op.lifecycle_facts(t.orders, "o_orderstatus", deny=["O", "P"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query
def hierarchy_resolve(t):
    cities = t.nation.select((F.col("n_nationkey") + 2000).cast("bigint").alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 1000).cast("bigint").alias("parent_id"))
    tree = (t.region.select((F.col("r_regionkey") + 1000).cast("bigint").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("bigint").alias("parent_id"))
            .unionByName(cities)
            .unionByName(t.supplier.select((F.col("s_suppkey") + 100000).alias("id"), F.col("s_name").alias("name"), (F.col("s_nationkey") + 2000).cast("bigint").alias("parent_id"))))
    orgs = (t.supplier.select((F.col("s_suppkey") + 100000).alias("org_id"), F.lit(2).alias("org_level"), (F.col("s_suppkey") + 100000).alias("region_id"))
            .unionByName(t.nation.select((F.col("n_nationkey") + 2000).cast("bigint").alias("org_id"), F.lit(1).alias("org_level"), (F.col("n_nationkey") + 2000).cast("bigint").alias("region_id"))))
    return op.hierarchy_resolve(orgs, tree, "org_level", "region_id")


@query
def metrics_full_outer(t):
    ordered = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("shipments"))
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy(F.to_date("l_shipdate").alias("day")).agg(sum_money("l_extendedprice", "returned"))
    return op.metrics_full_outer([ordered, shipped, returned], ["day"])


@query
def in_flight_balance(t):
    opened = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), sum_money("o_totalprice", "amount"))
    closed = t.orders.where("o_orderstatus = 'F'").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), sum_money("o_totalprice", "amount"))
    out = op.in_flight_balance(opened, closed, ["orders", "amount"], ["o_orderpriority"])
    return out.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


@query
def split_attribution(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_suppkey", "l_returnflag", "o_custkey", money("l_extendedprice").alias("distance"), F.lit(1).cast("bigint").alias("trips"))
    owners = [F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), F.when(F.col("l_returnflag") == "R", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))]
    split = op.split_attribution(lines, owners, "owner", ["distance"], ["trips"])
    return split.groupBy("owner").agg(F.sum("trips").alias("trips"), F.sum("distance").cast("decimal(18,2)").alias("distance"))


@query
def weighted_avg_query(t):
    lines = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    priced = lines.withColumns({"amount": money("l_extendedprice"), "qty": F.when(F.col("p_brand") != "Brand#1", F.col("l_quantity").cast("bigint")).otherwise(F.lit(0))})
    return priced.groupBy("p_brand").agg(weighted_avg("amount", "qty").cast("decimal(18,2)").alias("avg_price"))


QUERIES["weighted_avg"] = QUERIES.pop("weighted_avg_query")


@query
def write_partitions_query(t):
    path = f"{work_dir(t.spark)}/daily-{uuid.uuid4().hex}"
    daily = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("dt")).agg(F.count(F.lit(1)).alias("orders"))
    write_partitions(daily, path)
    # The second write replaces one month and must leave the others alone.
    write_partitions(daily.where("dt = '1998-06'").withColumn("orders", F.col("orders") + 1000), path)
    return t.spark.read.schema("orders bigint, dt string").parquet(path)


QUERIES["write_partitions"] = QUERIES.pop("write_partitions_query")


@query
def append_history(t):
    history = t.orders.where("o_orderstatus <> 'O'").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    new = t.orders.where("o_orderstatus <> 'F'").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return op.union_history(op.union_history(history, new), new)


@query
def date_spine(t):
    spine = op.date_spine(t.spark, date(1995, 1, 1), date(2001, 12, 31))
    daily = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(daily, F.col("date_id") == F.col("_d"), "left").drop("_d").withColumn("n", F.coalesce("n", F.lit(0)))


@query
def md5_bucket_query(t):
    return t.lineitem.groupBy(md5_bucket(F.col("l_orderkey"), 128, {"7": "9001"}).alias("bucket")).agg(F.count(F.lit(1)).alias("lines"))


QUERIES["md5_bucket"] = QUERIES.pop("md5_bucket_query")


@query
def epoch_normalise_query(t):
    both = t.events.select("event_id", F.when(F.expr("event_id % 2 = 0"), F.unix_seconds("ts")).otherwise(F.unix_millis("ts")).cast("string").alias("raw"))
    both = both.withColumn("raw", F.when(F.expr("event_id % 13 = 0"), F.lit("oops")).otherwise(F.col("raw")))
    return both.select("event_id", second_text(epoch_normalise(F.col("raw"))).alias("utc"), second_text(epoch_normalise(F.col("raw"), tz="GMT+8")).alias("local"))


QUERIES["epoch_normalise"] = QUERIES.pop("epoch_normalise_query")


@query
def latest_partition(t):
    return op.latest_partition(t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("dt")))


@query
def limit_sample(t):
    """Sample load: the first rows by key, ordered so that it is repeatable."""
    return op.first_rows(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 50)
