"""Online shop: dimensions, facts, rollups and reports as compositions of the operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import operators as op
from terrace.functions import epoch_normalise, in_last_days, money, pii_mask, rule_text, sum_money
from terrace.functions.text import ACTIVITY_RULES, COUPON_RULES
from terrace.operators.dims import fold_set
from terrace.operators.rollups import fan_out_recent_days
from terrace.operators.users import change_counts, channel_stats, cohort_rates, new_active_counts, repeat_rate
from terrace.plans.warehouse import Warehouse, job_table
from terrace.session import dealt_finely
from terrace.sources.writers import OPEN_DATE

JOBS, job = job_table()

SKU_COLUMNS = ["sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id",
               "category3_name", "tm_id", "tm_name"]
CATEGORY = SKU_COLUMNS[1:7]
PROVINCE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
AMOUNTS = ["original_amount", "activity_amount", "coupon_amount", "total_amount"]
ORDER_SUMS = {"order_original_amount_1d": "split_original_amount", "activity_reduce_amount_1d": "split_activity_amount",
              "coupon_reduce_amount_1d": "split_coupon_amount", "order_total_amount_1d": "split_total_amount"}
# Shape of the log documents.
LOG_SCHEMA = ("common struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,os:string,uid:string,vc:string,sid:string>, "
              "page struct<item:string,item_type:string,last_page_id:string,page_id:string,from_pos_id:string,from_pos_seq:string,"
              "refer_id:string,during_time:bigint>, ts bigint")
COMMON = {"province_id": "ar", "brand": "ba", "channel": "ch", "is_new": "is_new", "model": "md", "mid_id": "mid",
          "operate_system": "os", "user_id": "uid", "version_code": "vc"}
SHOP_ZONE = "GMT+8"


def _stamp(df: DataFrame, w: Warehouse) -> DataFrame:
    return df.withColumn("dt", F.lit(w.today))


def _day(c: str):
    return F.substring(F.col(c), 1, 10)


# ---- dimensions ----

@job
def dim_sku_full(w):
    attrs = fold_set(w["ods_sku_attr_value"], "sku_id", {c: F.col(c) for c in ("attr_id", "value_id", "attr_name", "value_name")}, "sku_attr_values")
    sale = fold_set(w["ods_sku_sale_attr_value"], "sku_id", {c: F.col(c) for c in (
        "sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name")}, "sku_sale_attr_values")
    flat = op.star_flatten(w["ods_sku_info"], [
        (w["ods_spu_info"], "spu_id", "id", {"spu_name": "spu_name"}),
        (w["ods_base_category3"], "category3_id", "id", {"name": "category3_name", "category2_id": "category2_id"}),
        (w["ods_base_category2"], "category2_id", "id", {"name": "category2_name", "category1_id": "category1_id"}),
        (w["ods_base_category1"], "category1_id", "id", {"name": "category1_name"}),
        (w["ods_base_trademark"], "tm_id", "id", {"tm_name": "tm_name"}),
        (attrs, "id", "sku_id", {"sku_attr_values": "sku_attr_values"}),
        (sale, "id", "sku_id", {"sku_sale_attr_values": "sku_sale_attr_values"})])
    return _stamp(flat, w)


@job
def dim_coupon_full(w):
    coupons = op.dict_decode(w["ods_coupon_info"], w["ods_base_dic"], "coupon_type", "coupon_type_name", "32")
    coupons = op.dict_decode(coupons, w["ods_base_dic"], "range_type", "range_type_name", "33")
    coupons = coupons.withColumn("benefit_rule", rule_text(F.col("coupon_type"), COUPON_RULES))
    return _stamp(coupons.withColumnsRenamed({"coupon_type": "coupon_type_code", "range_type": "range_type_code"}), w)


@job
def dim_activity_full(w):
    rules = op.star_flatten(w["ods_activity_rule"], [(w["ods_activity_info"], "activity_id", "id", {
        "activity_name": "activity_name", "activity_desc": "activity_desc", "start_time": "start_time", "end_time": "end_time",
        "create_time": "create_time"})])
    rules = op.dict_decode(rules, w["ods_base_dic"], "activity_type", "activity_type_name", "31")
    rules = rules.withColumn("benefit_rule", rule_text(F.col("activity_type"), ACTIVITY_RULES))
    return _stamp(rules.withColumnsRenamed({"id": "activity_rule_id", "activity_type": "activity_type_code"}), w)


@job
def dim_province_full(w):
    flat = op.star_flatten(w["ods_base_province"], [(w["ods_base_region"], "region_id", "id", {"region_name": "region_name"})])
    return _stamp(flat.withColumnRenamed("name", "province_name"), w)


@job
def dim_promotion_pos_full(w):
    return _stamp(w["ods_promotion_pos"], w)


@job
def dim_promotion_refer_full(w):
    return _stamp(w["ods_promotion_refer"], w)


def dim_date(spark, start: date = date(1995, 1, 1), end: date = date(2001, 12, 31)) -> DataFrame:
    """Calendar table; every column is text, as in the calendar file it replaces."""
    spine = op.date_spine(spark, start, end).withColumn("is_workday", F.col("is_workday").cast("int"))
    return spine.select(*[F.col(c).cast("string").alias(c) for c in spine.columns], F.lit(None).cast("string").alias("holiday_id"))


USER_TRACKED = ["name", "phone_num", "email", "user_level", "birthday", "gender", "create_time", "operate_time"]


def masked_users(users: DataFrame) -> DataFrame:
    return users.withColumns({"name": pii_mask(F.col("name"), "name"), "phone_num": pii_mask(F.col("phone_num"), "phone"),
                              "email": pii_mask(F.col("email"), "email")}).select("id", *USER_TRACKED)


@job
def dim_user_zip_init(w):
    return op.scd2_init(masked_users(w["ods_user_info"]), _day("create_time"))


@job
def dim_user_zip(w):
    """History table after today's changes, onto the stored history or the first load. Values are masked once, when they enter."""
    history = w.stored("dim_user_zip")
    history = w["dim_user_zip_init"] if history is None else history.drop("dt")
    merged = op.scd2_merge(history, masked_users(w["ods_user_info_inc"]), "id", USER_TRACKED, w.as_of)
    return merged.withColumn("dt", F.col("end_date"))


# ---- facts ----

@job
def dwd_trade_cart_add_inc(w):
    return w["ods_cart_info"].select("id", "user_id", "sku_id", _day("create_time").alias("date_id"), "create_time", "sku_num",
                                     _day("create_time").alias("dt"))


def _detail_sides(w):
    return ((w["ods_order_detail_activity"], "id", "order_detail_id", {"activity_id": "activity_id", "activity_rule_id": "activity_rule_id"}, "left"),
            (w["ods_order_detail_coupon"], "id", "order_detail_id", {"coupon_id": "coupon_id"}, "left"))


def _split_amounts(df):
    return df.withColumns({"split_original_amount": money(F.col("sku_num") * F.col("order_price")),
                           "split_activity_amount": money(F.coalesce("split_activity_amount", F.lit(0))),
                           "split_coupon_amount": money(F.coalesce("split_coupon_amount", F.lit(0)))}).drop("order_price")


@job
def dwd_trade_order_detail_inc(w):
    # The header comes last, so that a query that needs no line ids has them shuffled once.
    detail = w["ods_order_detail"]
    sides, header = _detail_sides(w), (w["ods_order_info"], "order_id", "id", {"user_id": "user_id", "province_id": "province_id"}, "left")
    added = [name for side in (header, *sides) for name in side[3].values()]
    wide = op.detail_enrich(detail, *sides, header).select(*detail.columns, *added)
    return _split_amounts(wide).withColumns({"date_id": _day("create_time"), "dt": _day("create_time")})


@job
def dwd_trade_pay_detail_suc_inc(w):
    wide = op.detail_enrich(
        w["ods_order_detail"].drop("create_time"),
        (w["ods_payment_info"], "order_id", "order_id", {"user_id": "user_id", "payment_type": "payment_type_code", "callback_time": "callback_time"}, "inner"),
        (w["ods_order_info"], "order_id", "id", {"province_id": "province_id"}, "left"), *_detail_sides(w))
    wide = op.dict_decode(_split_amounts(wide), w["ods_base_dic"], "payment_type_code", "payment_type_name", "11")
    return (wide.withColumnRenamed("split_total_amount", "split_payment_amount")
            .withColumns({"date_id": _day("callback_time"), "dt": _day("callback_time")}))


@job
def dwd_trade_cart_full(w):
    return op.snapshot_filter(w["ods_cart_info"], F.col("is_ordered") == "0", w.today).select("id", "user_id", "sku_id", "sku_name", "sku_num", "dt")


def flow_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("id").alias("order_id"), "user_id", "province_id", _day("create_time").alias("order_date_id"), F.col("create_time").alias("order_time"),
        *[F.lit(None).cast("string").alias(c) for c in ("payment_date_id", "payment_time", "finish_date_id", "finish_time")],
        F.col("original_total_amount").alias("order_original_amount"), F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"), F.col("total_amount").alias("order_total_amount"),
        F.lit(None).cast("decimal(16,2)").alias("payment_amount"))


def flow_milestones(payments: DataFrame, status_log: DataFrame):
    paid = payments.select("order_id", _day("callback_time").alias("payment_date_id"), F.col("callback_time").alias("payment_time"),
                           F.col("total_amount").alias("payment_amount"))
    done = status_log.where("order_status = '1004'").select("order_id", _day("operate_time").alias("finish_date_id"), F.col("operate_time").alias("finish_time"))
    return [(paid, {c: c for c in paid.columns[1:]}), (done, {c: c for c in done.columns[1:]})]


@job
def dwd_trade_trade_flow_acc_open(w):
    """Yesterday's snapshot: orders before today, with the milestones reached before today."""
    orders = w["ods_order_info"].where(F.col("create_time") < w.today)
    paid = w["ods_payment_info"].where(F.col("callback_time") < w.today)
    log = w["ods_order_status_log"].where(F.col("operate_time") < w.today)
    rows = flow_rows(orders)
    return op.accumulating_snapshot(rows.limit(0), rows, flow_milestones(paid, log), "order_id", "finish_time")


@job
def dwd_trade_trade_flow_acc(w):
    """Yesterday's open rows (stored, or else rebuilt) and today's orders, with today's milestones filled in."""
    before = w.stored("dwd_trade_trade_flow_acc")
    before = w["dwd_trade_trade_flow_acc_open"] if before is None else before
    still_open = before.where(F.col("dt") == OPEN_DATE).drop("dt")
    new = flow_rows(w["ods_order_info"].where(_day("create_time") == w.today))
    paid = w["ods_payment_info"].where(_day("callback_time") == w.today)
    log = w["ods_order_status_log"].where(_day("operate_time") == w.today)
    merged = op.accumulating_snapshot(still_open, new, flow_milestones(paid, log), "order_id", "finish_time")
    return merged.withColumn("payment_amount", F.coalesce("payment_amount", F.lit(0).cast("decimal(16,2)")))


@job
def dwd_tool_coupon_used_inc(w):
    return w["ods_coupon_use"].where("used_time is not null").select(
        "id", "coupon_id", "user_id", "order_id", _day("used_time").alias("date_id"), F.col("used_time").alias("payment_time"), _day("used_time").alias("dt"))


@job
def dwd_interaction_favor_add_inc(w):
    return w["ods_favor_info"].select("id", "user_id", "sku_id", _day("create_time").alias("date_id"), "create_time", _day("create_time").alias("dt"))


def _log(w):
    return op.parse_event_json(w["ods_z_log"].select("log"), "log", LOG_SCHEMA)


def _common(names=tuple(COMMON)):
    return [F.col(f"doc.common.{COMMON[n]}").alias(n) for n in names]


def _local(c="doc.ts"):
    return epoch_normalise(F.col(c), "ms", SHOP_ZONE)


@job
def dwd_traffic_page_view_inc(w):
    page = {"page_item": "item", "page_item_type": "item_type", "last_page_id": "last_page_id", "page_id": "page_id",
            "from_pos_id": "from_pos_id", "from_pos_seq": "from_pos_seq", "refer_id": "refer_id"}
    views = _log(w).where("doc.page is not null").select(
        *_common(), *[F.col(f"doc.page.{src}").alias(n) for n, src in page.items()], F.date_format(_local(), "yyyy-MM-dd").alias("date_id"),
        F.date_format(_local(), "yyyy-MM-dd HH:mm:ss").alias("view_time"), F.col("doc.common.sid").alias("session_id"),
        F.col("doc.page.during_time").alias("during_time"), F.col("doc.ts").alias("ts"))
    return views.withColumn("dt", F.col("date_id"))


DEVICE = ("channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system")


@job
def dwd_user_register_inc(w):
    """Registrations with the device seen on the registration page.

    A user may open that page more than once; the first view is taken, so that there is one row per user.
    """
    seen = _log(w).where("doc.page.page_id = 'register' and doc.common.uid is not null").select(
        F.col("doc.common.uid").alias("user_id"), F.col("doc.ts").alias("ts"), *_common(DEVICE))
    first = op.first_per_group(seen, ["user_id"], ["ts"]).drop("ts")
    users = w["ods_user_info"].select(F.col("id").alias("user_id"), _day("create_time").alias("date_id"), "create_time")
    return op.register_enrich(users, first, "user_id").withColumn("dt", F.col("date_id"))


@job
def dwd_user_login_inc(w):
    """First page view of each session of a known user."""
    seen = _log(w).where("doc.page is not null and doc.common.uid is not null").select(
        F.col("doc.common.sid").alias("sid"), F.col("doc.ts").alias("ts"), F.col("doc.common.uid").alias("user_id"), *_common(DEVICE))
    first = op.first_per_group(seen, ["sid"], ["ts"])
    local = _local("ts")
    return first.select("user_id", F.date_format(local, "yyyy-MM-dd").alias("date_id"), F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("login_time"),
                        *DEVICE, F.date_format(local, "yyyy-MM-dd").alias("dt"))


# ---- rollups ----

def _order_sums():
    return [sum_money(source, name) for name, source in ORDER_SUMS.items()]


@job
def dws_trade_user_sku_order_1d(w):
    daily = op.daily_rollup(w["dwd_trade_order_detail_inc"], ["user_id", "sku_id"], "dt", [
        F.count(F.lit(1)).alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_order_sums()])
    return op.star_flatten(daily, [(w["dim_sku_full"], "sku_id", "id", {c: c for c in SKU_COLUMNS})])


@job
def dws_trade_user_order_1d(w):
    # Dealt once, by what both levels of the distinct count share.
    return op.daily_rollup(dealt_finely(w["dwd_trade_order_detail_inc"], "user_id", "dt"), ["user_id"], "dt", [
        F.count_distinct("order_id").alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_order_sums()])


@job
def dws_trade_user_cart_add_1d(w):
    return op.daily_rollup(w["dwd_trade_cart_add_inc"], ["user_id"], "dt", [
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")])


@job
def dws_trade_province_order_1d(w):
    daily = op.daily_rollup(w["dwd_trade_order_detail_inc"], ["province_id"], "dt", [F.count_distinct("order_id").alias("order_count_1d"), *_order_sums()])
    return op.star_flatten(daily, [(w["dim_province_full"], "province_id", "id", {c: c for c in PROVINCE})])


@job
def dws_interaction_sku_favor_add_1d(w):
    daily = op.daily_rollup(w["dwd_interaction_favor_add_inc"], ["sku_id"], "dt", [F.count(F.lit(1)).alias("favor_add_count_1d")])
    return op.star_flatten(daily, [(w["dim_sku_full"], "sku_id", "id", {c: c for c in SKU_COLUMNS})])


@job
def dws_traffic_session_page_view_1d(w):
    return op.daily_rollup(w["dwd_traffic_page_view_inc"], ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"], "dt",
                           [F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d")])


@job
def dws_user_user_login_td_init(w):
    """To-date login profile of the registered users as of yesterday."""
    logins = (w["dwd_user_login_inc"].where(F.col("dt") < w.today).groupBy(F.col("user_id").alias("_u"))
              .agg(F.max("dt").alias("_last"), F.count(F.lit(1)).alias("_n")))
    users = w["dim_user_zip_init"].where(F.col("end_date") == OPEN_DATE).select(F.col("id").alias("user_id"), _day("create_time").alias("login_date_first"))
    return users.join(logins, F.col("user_id") == F.col("_u"), "left").select(
        "user_id", F.coalesce("_last", "login_date_first").alias("login_date_last"), "login_date_first",
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("login_count_td"))


@job
def dws_user_user_login_td(w):
    """The newest stored profile, or the initial one, with the days since then."""
    stored = w.before("dws_user_user_login_td")
    day, before = (w.days_ago(1), w["dws_user_user_login_td_init"]) if stored is None else (stored[0], stored[1].drop("dt"))
    since = w["dwd_user_login_inc"].where((F.col("dt") > day) & (F.col("dt") <= w.today)).groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("login_count_td"))
    return _stamp(op.to_date_merge_union(before, since, "user_id", w.as_of, ["login_count_td"], "login_date_first", "login_date_last", "dt"), w)


@job
def dws_traffic_page_visitor_page_view_1d(w):
    return op.daily_rollup(w["dwd_traffic_page_view_inc"], ["mid_id", "brand", "model", "operate_system", "page_id"], "dt",
                           [F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")])


@job
def dws_trade_user_payment_1d(w):
    return op.daily_rollup(w["dwd_trade_pay_detail_suc_inc"], ["user_id"], "dt", [
        F.count_distinct("order_id").alias("payment_count_1d"), F.sum("sku_num").alias("payment_num_1d"), sum_money("split_payment_amount", "payment_amount_1d")])


TD_MEASURES = ["order_count_td", "order_num_td", "original_amount_td", "activity_reduce_amount_td", "coupon_reduce_amount_td", "total_amount_td"]
TD_SOURCES = ["order_count_1d", "order_num_1d", *ORDER_SUMS]


def _td_daily(w):
    return w["dws_trade_user_order_1d"].withColumnsRenamed(dict(zip(TD_SOURCES, TD_MEASURES)))


def _td_types(df):
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in TD_MEASURES if "amount" in c})


def _td_yesterday(w):
    return _td_types(op.to_date_rebuild(_td_daily(w).where(F.col("dt") < w.today), "user_id", "dt", TD_MEASURES))


@job
def dws_trade_user_order_td(w):
    """The newest stored profile, or one of all days before, merged with the days since then by union, the cheapest of the three equal forms."""
    stored = w.before("dws_trade_user_order_td")
    day, before = (w.days_ago(1), _td_yesterday(w)) if stored is None else (stored[0], stored[1].drop("dt"))
    since = _td_daily(w).where((F.col("dt") > day) & (F.col("dt") <= w.today))
    return _stamp(op.to_date_merge_union(before, since, "user_id", w.as_of, TD_MEASURES, day="dt"), w)


@job
def dws_trade_user_order_td_outer(w):
    today = _td_daily(w).where(F.col("dt") == w.today)
    return _stamp(op.to_date_merge_outer(_td_yesterday(w), today, "user_id", w.as_of, TD_MEASURES), w)


@job
def dws_trade_user_order_td_rebuild(w):
    return _stamp(_td_types(op.to_date_rebuild(_td_daily(w).where(F.col("dt") <= w.today), "user_id", "dt", TD_MEASURES)), w)


def _nd(w, source, keys, measures):
    wide = op.nday_wide(w[source], "dt", w.as_of, keys, {m.removesuffix("_1d"): m for m in measures})
    return _stamp(wide.withColumns({c: F.col(c).cast("decimal(18,2)") for c in wide.columns if "amount" in c}), w)


@job
def dws_trade_user_sku_order_nd(w):
    return _nd(w, "dws_trade_user_sku_order_1d", ["user_id", "sku_id", *SKU_COLUMNS], ["order_count_1d", "order_num_1d", *ORDER_SUMS])


@job
def dws_trade_province_order_nd(w):
    return _nd(w, "dws_trade_province_order_1d", ["province_id", *PROVINCE], ["order_count_1d", *ORDER_SUMS])


@job
def dws_tool_user_coupon_coupon_used_1d(w):
    daily = op.daily_rollup(w["dwd_tool_coupon_used_inc"], ["user_id", "coupon_id"], "dt", [F.count(F.lit(1)).alias("used_count_1d")])
    return op.star_flatten(daily, [(w["dim_coupon_full"], "coupon_id", "id", {c: c for c in (
        "coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule")})])


# ---- reports ----

@job
def ads_traffic_stats_by_channel(w):
    return _stamp(channel_stats(w["dws_traffic_session_page_view_1d"], "dt", "channel", "mid_id", w.as_of), w)


@job
def ads_page_path(w):
    views = (w["dwd_traffic_page_view_inc"].where(F.col("dt") == w.today)
             .withColumns({"viewed": F.timestamp_millis("ts"), "tie": F.col("page_item")}))
    return _stamp(op.page_path(views, ["session_id"], "page_id", "viewed", "tie"), w)


@job
def ads_user_change(w):
    before = w["dws_user_user_login_td_init"].select("user_id", F.col("login_date_last").alias("login_date_previous"))
    profile = w["dws_user_user_login_td"].join(before, "user_id", "left")
    return _stamp(change_counts(profile, "login_date_last", "login_date_previous", w.as_of), w)


@job
def ads_user_retention(w):
    return _stamp(cohort_rates(w["dws_user_user_login_td"], "login_date_first", "login_date_last", w.as_of), w)


@job
def ads_user_stats(w):
    return _stamp(new_active_counts(w["dws_user_user_login_td"], "login_date_first", "login_date_last", w.as_of), w)


@job
def ads_user_action(w):
    """Funnel of one day: four one-row frames side by side."""
    def rows(name, alias):
        return w[name].where(F.col("dt") == w.today).agg(F.count(F.lit(1)).alias(alias))

    pages = w["dws_traffic_page_visitor_page_view_1d"].where(F.col("dt") == w.today).agg(
        F.count_if(F.col("page_id") == "home").alias("home_count"), F.count_if(F.col("page_id") == "good_detail").alias("good_detail_count"))
    parts = [pages, rows("dws_trade_user_cart_add_1d", "cart_count"), rows("dws_trade_user_order_1d", "order_count"),
             rows("dws_trade_user_payment_1d", "payment_count")]
    one = F.lit(w.today).alias("dt")
    return op.metrics_full_outer([p.select(one, "*") for p in parts], ["dt"])


@job
def ads_new_order_user_stats(w):
    first = fan_out_recent_days(w["dws_trade_user_order_td"], "order_date_first", w.as_of)
    return _stamp(first.groupBy("recent_days").agg(F.count(F.lit(1)).alias("new_order_user_count")), w)


@job
def ads_order_continuously_user_count(w):
    days = op.consecutive_days(w["dws_trade_user_order_1d"], "user_id", "dt", w.as_of)
    return _stamp(days.withColumn("recent_days", F.lit(7)), w)


@job
def ads_repeat_purchase_by_tm(w):
    per_user = w["dws_trade_user_sku_order_nd"].groupBy("user_id", "tm_id", "tm_name").agg(F.sum("order_count_30d").alias("n"))
    return _stamp(repeat_rate(per_user, ["tm_id", "tm_name"], "n").withColumn("recent_days", F.lit(30)), w)


def _order_stats(w, keys):
    return _stamp(op.stats_by_dim(w["dws_trade_user_sku_order_1d"], keys, "user_id", "dt", w.as_of, count=F.col("order_count_1d")), w)


@job
def ads_order_stats_by_tm(w):
    return _order_stats(w, ["tm_id", "tm_name"])


@job
def ads_order_stats_by_cate(w):
    return _order_stats(w, CATEGORY)


@job
def ads_sku_cart_num_top3_by_cate(w):
    stock = w["dwd_trade_cart_full"].groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    named = op.star_flatten(stock, [(w["dim_sku_full"], "sku_id", "id", {c: c for c in ("sku_name", *CATEGORY)})])
    return _stamp(op.topk_with_ties(named, ["category1_id", "category2_id", "category3_id"], "cart_num", 3), w)


@job
def ads_sku_favor_count_top3_by_tm(w):
    favor = w["dws_interaction_sku_favor_add_1d"].where(F.col("dt") == w.today).select(
        "tm_id", "tm_name", "sku_id", "sku_name", F.col("favor_add_count_1d").alias("favor_count"))
    return _stamp(op.topk_with_ties(favor, ["tm_id"], "favor_count", 3), w)


@job
def ads_order_to_pay_interval_avg(w):
    rows = w["dwd_trade_trade_flow_acc"].where(F.col("dt").isin(OPEN_DATE, w.today))
    rows = rows.withColumns({c: F.to_timestamp(c) for c in ("order_time", "payment_time")})
    return _stamp(op.avg_interval_seconds(rows, "order_time", "payment_time", name="order_to_pay_interval_avg"), w)


@job
def ads_order_by_province(w):
    keys = ["province_id", *PROVINCE]
    one = w["dws_trade_province_order_1d"].where(F.col("dt") == w.today).select(
        F.lit(1).alias("recent_days"), *keys, F.col("order_count_1d").alias("order_count"), F.col("order_total_amount_1d").alias("order_total_amount"))
    wide = w["dws_trade_province_order_nd"]
    many = wide.select(*keys, F.inline(F.array(*[F.struct(
        F.lit(n).alias("recent_days"), F.col(f"order_count_{n}d").alias("order_count"), F.col(f"order_total_amount_{n}d").alias("order_total_amount"))
        for n in (7, 30)])))
    return _stamp(one.unionByName(many).distinct(), w)


@job
def ads_coupon_stats(w):
    day = w["dws_tool_user_coupon_coupon_used_1d"].where(F.col("dt") == w.today)
    return _stamp(day.groupBy("coupon_id", "coupon_name").agg(F.sum("used_count_1d").alias("used_count"), F.count(F.lit(1)).alias("used_user_count")), w)
