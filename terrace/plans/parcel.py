"""Parcel logistics: dimensions, facts, rollups and reports as compositions of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace import operators as op
from terrace.functions import epoch_day, epoch_normalise, initial_mask, iso_text, pii_hash, weighted_avg
from terrace.functions.text import EMAIL_STRICT, PHONE_STRICT
from terrace.operators.dims import fold_set
from terrace.operators.rollups import fan_out_recent_days
from terrace.plans.warehouse import Warehouse, job_table
from terrace.session import dealt_finely
from terrace.sources.writers import OPEN_DATE

JOBS, job = job_table()
DAYS = (7, 30)
CITY = ["city_id", "city_name"]
PROVINCE = ["province_id", "province_name"]
TRANS = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def _live(w: Warehouse, name: str) -> DataFrame:
    df = w[name]
    return df.where("is_deleted = '0'").drop("is_deleted")


def _stamp(df: DataFrame, w: Warehouse) -> DataFrame:
    return df.withColumn("dt", F.lit(w.today))


def _utc(c: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(epoch_normalise(F.col(c), "ms"), fmt)


def _total(c: str, name: str | None = None) -> Column:
    return F.sum(c).cast("decimal(18,2)").alias(name or c)


def _decode(df: DataFrame, dic: DataFrame, code: str, name: str) -> DataFrame:
    return op.dict_decode(df, dic, code, name, dic_code="id", dic_name="name")


# ---- dimensions ----

@job
def dim_complex_full(w):
    regions = _live(w, "ods_base_region_info")
    couriers = fold_set(_live(w, "ods_express_courier_complex"), "complex_id", {"id": F.col("courier_emp_id").cast("string")}, "couriers")
    flat = op.star_flatten(_live(w, "ods_base_complex"), [(regions, "province_id", "id", {"name": "province_name"}), (regions, "city_id", "id", {"name": "city_name"})], how="inner")
    flat = op.star_flatten(flat, [(couriers, "id", "complex_id", {"couriers": "courier_emp_ids"})])
    return _stamp(flat.withColumn("courier_emp_ids", F.transform("courier_emp_ids", lambda c: c["id"])), w)


@job
def dim_organ_full(w):
    organs = _live(w, "ods_base_organ")
    return _stamp(op.star_flatten(organs, [
        (_live(w, "ods_base_region_info"), "region_id", "id", {"name": "region_name", "dict_code": "region_code"}),
        (organs, "org_parent_id", "id", {"org_name": "org_parent_name"})]), w)


@job
def dim_region_full(w):
    return _stamp(_live(w, "ods_base_region_info"), w)


@job
def dim_express_courier_full(w):
    couriers = _live(w, "ods_express_courier").withColumn("working_phone", pii_hash(F.col("working_phone")))
    couriers = op.star_flatten(couriers, [(_live(w, "ods_base_organ"), "org_id", "id", {"org_name": "org_name"})], how="inner")
    named = _decode(couriers, _live(w, "ods_base_dic"), "express_type", "express_type_name")
    return _stamp(named.where("express_type_name is not null"), w)


@job
def dim_shift_full(w):
    line = {c: c for c in ("line_no", "line_level", "org_id", "transport_line_type_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name",
                           "pair_line_id", "distance", "cost", "estimated_time")}
    shifts = op.star_flatten(_live(w, "ods_line_base_shift"), [(_live(w, "ods_line_base_info"), "line_id", "id", {"name": "line_name", **line})], how="inner")
    named = _decode(shifts, _live(w, "ods_base_dic"), "transport_line_type_id", "transport_line_type_name")
    return _stamp(named.where("transport_line_type_name is not null"), w)


@job
def dim_truck_driver_full(w):
    return _stamp(op.star_flatten(_live(w, "ods_truck_driver"), [
        (_live(w, "ods_base_organ"), "org_id", "id", {"org_name": "org_name"}), (_live(w, "ods_truck_team"), "team_id", "id", {"name": "team_name"})], how="inner"), w)


@job
def dim_truck_full(w):
    model = {c: c for c in ("truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg", "max_speed", "oil_vol")}
    trucks = _live(w, "ods_truck_info").withColumn("truck_no", pii_hash(F.col("truck_no")))
    flat = op.star_flatten(trucks, [
        (_live(w, "ods_truck_team"), "team_id", "id", {"name": "team_name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}),
        (_live(w, "ods_truck_model"), "truck_model_id", "id", {"model_name": "truck_model_name", "model_type": "truck_model_type", "model_no": "truck_model_no", "brand": "truck_brand", **model}),
        (_live(w, "ods_base_organ"), "org_id", "id", {"org_name": "org_name"})], how="inner")
    dic = _live(w, "ods_base_dic")
    flat = _decode(_decode(flat, dic, "truck_model_type", "truck_model_type_name"), dic, "truck_brand", "truck_brand_name")
    return _stamp(flat.where("truck_model_type_name is not null and truck_brand_name is not null"), w)


@job
def dim_user_zip(w):
    users = _live(w, "ods_user_info").withColumns({
        "passwd": pii_hash(F.col("passwd")), "real_name": pii_hash(F.col("real_name")), "phone_num": pii_hash(F.col("phone_num"), PHONE_STRICT),
        "email": pii_hash(F.col("email"), EMAIL_STRICT), "birthday": F.date_format(epoch_day(F.col("birthday")), "yyyy-MM-dd")})
    return _stamp(op.scd2_init(users, _utc("create_time", "yyyy-MM-dd")).drop("create_time"), w)


@job
def dim_user_address_zip(w):
    rows = _live(w, "ods_user_address").withColumn("phone", pii_hash(F.col("phone"), PHONE_STRICT))
    return _stamp(op.scd2_init(rows, iso_text(F.col("create_time"))).drop("create_time"), w)


# ---- facts ----

ORDER_COLUMNS = ["order_no", "status", "collect_type", "user_id", "receiver_complex_id", "receiver_province_id", "receiver_city_id", "receiver_district_id",
                 "receiver_name", "sender_complex_id", "sender_province_id", "sender_city_id", "sender_district_id", "sender_name", "payment_type", "cargo_num",
                 "amount", "estimate_arrive_time", "distance", "update_time"]


def order_facts(w: Warehouse, time_name: str, allow: Sequence[str] | None = None, deny: Sequence[str] | None = None,
                from_cargo: bool = False, with_payment: bool = True) -> DataFrame:
    """Cargo rows of the orders whose status qualifies, with decoded names: one definition for every life-cycle fact.

    `time_name` is the update time of the order, or the creation time of the cargo when `from_cargo`.
    """
    orders = _live(w, "ods_order_info").withColumns({
        "receiver_name": initial_mask(F.col("receiver_name")), "sender_name": initial_mask(F.col("sender_name")), "estimate_arrive_time": _utc("estimate_arrive_time")})
    if allow is not None or deny is not None:
        orders = op.lifecycle_facts(orders, "status", allow, deny)
    wide = op.detail_enrich(_live(w, "ods_order_cargo"), (orders, "order_id", "id", {c: c for c in ORDER_COLUMNS}, "inner"))
    dic = _live(w, "ods_base_dic")
    codes = ["cargo_type", "status", "collect_type", *(["payment_type"] if with_payment else [])]
    for code in codes:
        wide = _decode(wide, dic, code, f"{code}_name")
    wide = wide.withColumn(time_name, iso_text(F.col("create_time" if from_cargo else "update_time")))
    return wide.drop("create_time", *([] if with_payment else ["payment_type"])).withColumn("dt", F.substring(time_name, 1, 10))


@job
def dwd_trade_order_detail_inc(w):
    return order_facts(w, "order_time", from_cargo=True, with_payment=False).drop("update_time")


# Which status codes say that a step has been reached.
LIFECYCLE = {
    "dwd_trade_pay_suc_detail_inc": ("payment_time", None, ["60010", "60999"]),
    "dwd_trade_order_cancel_detail_inc": ("cancel_time", ["60020"], None),
    "dwd_trans_receive_detail_inc": ("receive_time", None, ["60010", "60020", "60999"]),
    "dwd_trans_dispatch_detail_inc": ("dispatch_time", None, ["60010", "60020", "60030", "60040", "60999"]),
    "dwd_trans_bound_finish_detail_inc": ("bound_finish_time", None, ["60020", "60030", "60040", "60050"]),
    "dwd_trans_deliver_suc_detail_inc": ("deliver_suc_time", None, ["60020", "60030", "60040"]),
    "dwd_trans_sign_detail_inc": ("sign_time", None, ["60020", "60030", "60040", "60050"]),
}


def _lifecycle(name, time_name, allow, deny):
    def build(w):
        return order_facts(w, time_name, allow, deny).drop("update_time")
    build.__name__ = name
    return job(build)


for _name, _rule in LIFECYCLE.items():
    _lifecycle(_name, *_rule)


@job
def dwd_trade_order_process_inc(w):
    """Accumulating order process: cancelled and received orders close on their update day."""
    rows = order_facts(w, "order_time", from_cargo=True)
    closed = F.when(F.col("status").isin("60020", "60030"), F.substring("update_time", 1, 10)).otherwise(F.lit(OPEN_DATE))
    rows = rows.withColumns({"start_date": F.substring("order_time", 1, 10), "end_date": closed})
    return rows.withColumn("dt", F.col("end_date")).drop("update_time")


@job
def dwd_trans_trans_finish_inc(w):
    rows = _live(w, "ods_transport_task").where("actual_end_time is not null")
    seconds = ((F.col("actual_end_time").cast("bigint") - F.col("actual_start_time").cast("bigint")) / 1000).cast("bigint")
    rows = rows.withColumns({"driver1_name": initial_mask(F.col("driver1_name")), "driver2_name": initial_mask(F.col("driver2_name")),
                             "truck_no": pii_hash(F.col("truck_no")), "finish_dur_sec": seconds, "dt": _utc("actual_end_time", "yyyy-MM-dd")})
    # The shift dimension contributes no column and has one row per shift, so its left join changes nothing.
    return rows.withColumns({c: _utc(c) for c in ("actual_start_time", "actual_end_time")})


def _bound(w, time, emp):
    return (w["ods_order_org_bound"].where(F.col(time).isNotNull())
            .select("id", "order_id", "org_id", _utc(time).alias(time), emp, _utc(time, "yyyy-MM-dd").alias("dt")))


@job
def dwd_bound_inbound_inc(w):
    return _bound(w, "inbound_time", "inbound_emp_id")


@job
def dwd_bound_sort_inc(w):
    return _bound(w, "sort_time", "sorter_emp_id")


@job
def dwd_bound_outbound_inc(w):
    return _bound(w, "outbound_time", "outbound_emp_id")


# ---- rollups ----

def _organs_by_region(w):
    return w["dim_organ_full"].select(F.col("region_id").cast("string").alias("_region"), F.col("id").alias("org_id"), "org_name", "org_level", "region_id")


@job
def dws_trade_org_cargo_type_order_1d(w):
    """Every order counts once per organisation, cargo type and day, with its amount taken once."""
    once = dealt_finely(w["dwd_trade_order_detail_inc"], "order_id").groupBy("order_id", "cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id", "dt").agg(F.max("amount").alias("amount"))
    # Aggregated down to districts before the organisation is looked up: the join then sees few rows.
    by_district = once.groupBy("sender_district_id", "sender_city_id", "cargo_type", "cargo_type_name", "dt").agg(
        F.count("order_id").alias("order_count"), _total("amount", "order_amount"))
    named = op.star_flatten(by_district, [(_organs_by_region(w), "sender_district_id", "_region", {"org_id": "org_id", "org_name": "org_name"})])
    keys = ["org_id", "org_name", "city_id", "cargo_type", "cargo_type_name", "dt"]
    agg = named.withColumn("city_id", F.col("sender_city_id").cast("bigint")).groupBy(*keys).agg(F.sum("order_count").alias("order_count"), _total("order_amount"))
    return op.star_flatten(agg, [(w["dim_region_full"], "city_id", "id", {"name": "city_name"})])


def _resolve(w, df, district):
    """Organisation of a district and its city and province."""
    named = op.star_flatten(df, [(_organs_by_region(w), district, "_region", {"org_id": "org_id", "org_name": "org_name", "org_level": "org_level", "region_id": "region_id"})])
    # The organisation's own region is the first step of the walk whatever its level, and the parents follow.
    walked = op.hierarchy_resolve(named.withColumn("org_level", F.lit(2)), w["dim_region_full"], "org_level", "region_id")
    return walked.drop("org_level", "region_id")


@job
def dws_trans_org_receive_1d(w):
    by_district = op.dedup_then_sum(w["dwd_trans_receive_detail_inc"], "order_id", "amount", ["sender_district_id", "dt"])
    keys = ["org_id", "org_name", *CITY, *PROVINCE, "dt"]
    return _resolve(w, by_district, "sender_district_id").groupBy(*keys).agg(F.sum("order_count").alias("order_count"), _total("order_amount"))


@job
def dws_trans_dispatch_1d(w):
    return op.dedup_then_sum(w["dwd_trans_dispatch_detail_inc"], "order_id", "amount", ["dt"])


@job
def dws_trans_org_truck_model_type_trans_finish_1d(w):
    by_truck = w["dwd_trans_trans_finish_inc"].groupBy("start_org_id", "start_org_name", "truck_id", "dt").agg(
        F.count("id").alias("trans_finish_count"), _total("actual_distance", "trans_finish_distance"), F.sum("finish_dur_sec").alias("trans_finish_dur_sec"))
    named = op.star_flatten(by_truck, [(w["dim_truck_full"], "truck_id", "id", {c: c for c in ("truck_model_type", "truck_model_type_name")})])
    return named.groupBy(F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_model_type", "truck_model_type_name", "dt").agg(
        F.sum("trans_finish_count").alias("trans_finish_count"), _total("trans_finish_distance"), F.sum("trans_finish_dur_sec").alias("trans_finish_dur_sec"))


@job
def dws_trans_org_deliver_suc_1d(w):
    once = w["dwd_trans_deliver_suc_detail_inc"].select("order_id", "receiver_district_id", "dt").distinct()
    by_district = once.groupBy("receiver_district_id", "dt").agg(F.count("order_id").alias("order_count"))
    return _resolve(w, by_district, "receiver_district_id").groupBy("org_id", "org_name", *CITY, *PROVINCE, "dt").agg(F.sum("order_count").alias("order_count"))


@job
def dws_trans_org_sort_1d(w):
    agg = w["dwd_bound_sort_inc"].groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    named = op.star_flatten(agg, [(w["dim_organ_full"], "org_id", "id", {"org_name": "org_name", "org_level": "org_level", "region_id": "region_id"})])
    return op.hierarchy_resolve(named, w["dim_region_full"], "org_level", "region_id").drop("org_level", "region_id")


def _nd(w, source, keys, aggs):
    return _stamp(op.recent_days_rollup(w[source], "dt", w.as_of, DAYS, keys, aggs), w)


COUNT_AMOUNT = lambda: [F.sum("order_count").alias("order_count"), _total("order_amount")]


@job
def dws_trade_org_cargo_type_order_nd(w):
    return _nd(w, "dws_trade_org_cargo_type_order_1d", ["org_id", "org_name", *CITY, "cargo_type", "cargo_type_name"], COUNT_AMOUNT())


@job
def dws_trans_org_receive_nd(w):
    return _nd(w, "dws_trans_org_receive_1d", ["org_id", "org_name", *CITY, *PROVINCE], COUNT_AMOUNT())


@job
def dws_trans_dispatch_nd(w):
    return _nd(w, "dws_trans_dispatch_1d", [], COUNT_AMOUNT())


@job
def dws_trans_shift_trans_finish_nd(w):
    keys = ["shift_id", "line_id", "truck_id", F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name"]
    agg = fan_out_recent_days(w["dwd_trans_trans_finish_inc"], "dt", w.as_of, DAYS).groupBy("recent_days", *keys).agg(
        F.count("id").alias("trans_finish_count"), _total("actual_distance", "trans_finish_distance"), F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
        F.sum("order_num").alias("trans_finish_order_count"))
    named = op.star_flatten(agg, [(w["dim_organ_full"], "org_id", "id", {"org_level": "org_level", "region_id": "region_id"})])
    named = op.hierarchy_resolve(named, w["dim_region_full"], "org_level", "region_id", province=False).drop("org_level", "region_id")
    named = op.star_flatten(named, [(w["dim_shift_full"], "shift_id", "id", {"line_name": "line_name"}),
                                    (w["dim_truck_full"], "truck_id", "id", {c: c for c in ("truck_model_type", "truck_model_type_name")})])
    return _stamp(named.drop("truck_id"), w)


@job
def dws_trans_org_deliver_suc_nd(w):
    return _nd(w, "dws_trans_org_deliver_suc_1d", ["org_id", "org_name", *CITY, *PROVINCE], [F.sum("order_count").alias("order_count")])


@job
def dws_trans_org_sort_nd(w):
    return _nd(w, "dws_trans_org_sort_1d", ["org_id", "org_name", *CITY, *PROVINCE], [F.sum("sort_count").alias("sort_count")])


@job
def dws_trans_dispatch_td(w):
    return _stamp(w["dws_trans_dispatch_1d"].where(F.col("dt") <= w.today).agg(*COUNT_AMOUNT()), w)


@job
def dws_trans_bound_finish_td(w):
    rows = w["dwd_trans_bound_finish_detail_inc"].where(F.col("dt") <= w.today)
    return _stamp(op.dedup_then_sum(rows, "order_id", "amount", []), w)


# ---- reports ----

REPORT_DAYS = (1, *DAYS)


def _recent(w, daily: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """The day itself and the last 7 and 30 days from one pass over a daily table."""
    return op.recent_days_rollup(w[daily], "dt", w.as_of, REPORT_DAYS, keys, aggs)


def _orders(w, keys, prefix=""):
    return _recent(w, "dws_trade_org_cargo_type_order_1d", keys, [F.sum("order_count").alias(f"{prefix}order_count"), _total("order_amount", f"{prefix}order_amount")])


def _receives(w, keys):
    return _recent(w, "dws_trans_org_receive_1d", keys, [F.sum("order_count").alias("receive_order_count"), _total("order_amount", "receive_order_amount")])


def _delivers(w, keys):
    return _recent(w, "dws_trans_org_deliver_suc_1d", keys, [F.sum("order_count").alias("deliver_suc_count")])


def _sorts(w, keys):
    return _recent(w, "dws_trans_org_sort_1d", keys, [F.sum("sort_count").alias("sort_count")])


def _trans_sums():
    return [F.sum("trans_finish_count").alias("trans_finish_count"), _total("trans_finish_distance"), F.sum("trans_finish_dur_sec").cast("bigint").alias("trans_finish_dur_sec")]


def _trans_means():
    return [weighted_avg("trans_finish_distance", "trans_finish_count").cast("decimal(16,2)").alias("avg_trans_finish_distance"),
            weighted_avg("trans_finish_dur_sec", "trans_finish_count").cast("bigint").alias("avg_trans_finish_dur_sec")]


@job
def ads_trans_order_stats(w):
    dispatches = _recent(w, "dws_trans_dispatch_1d", [], [F.sum("order_count").alias("dispatch_order_count"), _total("order_amount", "dispatch_order_amount")])
    return _stamp(op.metrics_full_outer([_receives(w, []), dispatches], ["recent_days"]), w)


@job
def ads_trans_stats(w):
    return _stamp(_recent(w, "dws_trans_org_truck_model_type_trans_finish_1d", [], _trans_sums()), w)


@job
def ads_trans_order_stats_td(w):
    out = op.in_flight_balance(w["dws_trans_dispatch_td"], w["dws_trans_bound_finish_td"], ["order_count", "order_amount"], ["dt"])
    return out.select("dt", F.col("order_count").alias("bounding_order_count"), F.col("order_amount").cast("decimal(18,2)").alias("bounding_order_amount"))


@job
def ads_order_stats(w):
    return _stamp(_orders(w, []), w)


@job
def ads_order_cargo_type_stats(w):
    return _stamp(_orders(w, ["cargo_type", "cargo_type_name"]), w)


@job
def ads_city_stats(w):
    trans = _recent(w, "dws_trans_org_truck_model_type_trans_finish_1d", ["org_id"], _trans_sums())
    organs = op.hierarchy_resolve(w["dim_organ_full"].select(F.col("id").alias("_org"), "org_level", "region_id"), w["dim_region_full"], "org_level", "region_id", province=False)
    trans = op.star_flatten(trans, [(organs, "org_id", "_org", {c: c for c in CITY})]).groupBy("recent_days", *CITY).agg(*_trans_sums(), *_trans_means())
    return _stamp(op.metrics_full_outer([_orders(w, CITY), trans], ["recent_days", *CITY]), w)


@job
def ads_org_stats(w):
    """Orders and transports per organisation: either of them for one day, both of them for 7 and 30 days."""
    keys = ["org_id", "org_name"]
    trans = _recent(w, "dws_trans_org_truck_model_type_trans_finish_1d", keys, [*_trans_sums(), *_trans_means()])
    both = op.metrics_full_outer([_orders(w, keys), trans], ["recent_days", *keys])
    return _stamp(both.where("recent_days = 1 or (order_count is not null and trans_finish_count is not null)"), w)


@job
def ads_shift_stats(w):
    return w["dws_trans_shift_trans_finish_nd"].select("dt", "recent_days", "shift_id", *TRANS, "trans_finish_order_count")


@job
def ads_line_stats(w):
    return _stamp(w["dws_trans_shift_trans_finish_nd"].groupBy("recent_days", "line_id", "line_name").agg(
        *_trans_sums(), F.sum("trans_finish_order_count").alias("trans_finish_order_count")), w)


@job
def ads_driver_stats(w):
    """Distance and time are shared by the two drivers of a shift; the number of trips is not."""
    owners = [F.struct(F.col(f"driver{i}_emp_id").alias("id"), F.col(f"driver{i}_name").alias("name")) for i in (1, 2)]
    owners = [F.when(F.col("driver1_emp_id").isNotNull(), owners[0]), F.when(F.col("driver2_emp_id").isNotNull(), owners[1])]
    rows = op.split_attribution(w["dws_trans_shift_trans_finish_nd"], owners, "driver", ["trans_finish_distance", "trans_finish_dur_sec"], ["trans_finish_count", "recent_days"])
    return _stamp(rows.groupBy("recent_days", F.col("driver.id").alias("driver_emp_id"), F.col("driver.name").alias("driver_name")).agg(*_trans_sums(), *_trans_means()), w)


@job
def ads_truck_stats(w):
    return _stamp(w["dws_trans_shift_trans_finish_nd"].groupBy("recent_days", "truck_model_type", "truck_model_type_name").agg(*_trans_sums(), *_trans_means()), w)


@job
def ads_express_stats(w):
    return _stamp(op.metrics_full_outer([_delivers(w, []), _sorts(w, [])], ["recent_days"]), w)


def _express(w, keys):
    return _stamp(op.metrics_full_outer([_delivers(w, keys), _sorts(w, keys), _receives(w, keys)], ["recent_days", *keys]), w)


@job
def ads_express_province_stats(w):
    return _express(w, PROVINCE)


@job
def ads_express_city_stats(w):
    return _express(w, CITY)


@job
def ads_express_org_stats(w):
    return _express(w, ["org_id", "org_name"])
