"""Views that rebuild every parcel table in DuckDB, one per job."""

from oracles.operators import big, dec

D = "'1998-06-30'"
N2 = "(VALUES (7), (30)) n(recent_days)"
IN_N = "dt > strftime(DATE '1998-06-30' - recent_days, '%Y-%m-%d') AND dt <= '1998-06-30'"
STRICT = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
MAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def live(table: str) -> str:
    return f"(SELECT * EXCLUDE (is_deleted) FROM {table} WHERE is_deleted = '0')"


def utc(x: str, fmt: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(make_timestamp(CAST({x} AS BIGINT) * 1000), '{fmt}')"


def iso(x: str) -> str:
    return f"substr({x}, 1, 10) || ' ' || substr({x}, 12, 8)"


DIC = live("ods_base_dic")
ORDER_COLS = """order_no, status, collect_type, user_id, receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id,
  substr(receiver_name, 1, 1) || '*' AS receiver_name, sender_complex_id, sender_province_id, sender_city_id, sender_district_id,
  substr(sender_name, 1, 1) || '*' AS sender_name, cargo_num, amount, distance"""


def facts(time: str, where: str = "true", cargo: bool = False, pay: bool = True, extra: str = "", dt: str | None = None) -> str:
    stamp = iso("c.create_time" if cargo else "o.update_time")
    pay_cols = ", payment_type, dp.name AS payment_type_name" if pay else ""
    pay_join = f"LEFT JOIN {DIC} dp ON CAST(dp.id AS VARCHAR) = o.payment_type" if pay else ""
    return f"""SELECT c.id, order_id, cargo_type, dc.name AS cargo_type_name, volume_length, volume_width, volume_height, weight, {stamp} AS {time},
      ds.name AS status_name, dl.name AS collect_type_name, {ORDER_COLS}, {utc('estimate_arrive_time')} AS estimate_arrive_time{pay_cols}{extra}, {dt or f'substr({stamp}, 1, 10)'} AS dt
      FROM {live('ods_order_cargo')} c JOIN {live('ods_order_info')} o ON o.id = c.order_id AND ({where})
      LEFT JOIN {DIC} dc ON CAST(dc.id AS VARCHAR) = cargo_type LEFT JOIN {DIC} ds ON CAST(ds.id AS VARCHAR) = o.status
      LEFT JOIN {DIC} dl ON CAST(dl.id AS VARCHAR) = o.collect_type {pay_join}"""


def deny(*codes: str) -> str:
    return "o.status NOT IN (" + ", ".join(f"'{c}'" for c in codes) + ")"


def bound(time: str, emp: str) -> str:
    return f"SELECT id, order_id, org_id, {utc(time)} AS {time}, {emp}, {utc(time, '%Y-%m-%d')} AS dt FROM ods_order_org_bound WHERE {time} IS NOT NULL"


PLACE = "org_id, org_name, city_id, city_name, province_id, province_name"
WALK = """LEFT JOIN dim_organ_full g ON CAST(g.region_id AS VARCHAR) = {0} LEFT JOIN dim_region_full d ON d.id = g.region_id
  LEFT JOIN dim_region_full c ON c.id = d.parent_id LEFT JOIN dim_region_full p ON p.id = c.parent_id"""
WALKED = "g.id AS org_id, g.org_name, c.id AS city_id, c.name AS city_name, p.id AS province_id, p.name AS province_name"


def nd(source: str, keys: str, aggs: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"SELECT recent_days, {lead}{aggs}, {D} AS dt FROM {source}, {N2} WHERE {IN_N} GROUP BY ALL"


COUNT_AMOUNT = f"{big('sum(order_count)')} AS order_count, {dec('sum(order_amount)')} AS order_amount"
TRANS = f"""{big('sum(trans_finish_count)')} AS trans_finish_count, {dec('sum(trans_finish_distance)')} AS trans_finish_distance,
  {big('trunc(sum(trans_finish_dur_sec))')} AS trans_finish_dur_sec"""
# Spark divides decimals exactly; as a double the quotient could fall on the wrong side of a half cent.
MEANS = f"""CAST((sum(CAST(trans_finish_distance * 2 AS DECIMAL(18,2))) * 1000000 // (2 * sum(trans_finish_count))) / 1000000 AS DECIMAL(16,2)) AS avg_trans_finish_distance,
  {big('trunc(sum(trans_finish_dur_sec) / sum(trans_finish_count))')} AS avg_trans_finish_dur_sec"""
ONE_TRANS, N_TRANS = "dws_trans_org_truck_model_type_trans_finish_1d", "dws_trans_shift_trans_finish_nd"


def one_and_n(one: str, many: str, keys: str, aggs: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""(SELECT 1 AS recent_days, {lead}{aggs} FROM {one} WHERE dt = {D} {'GROUP BY ALL' if keys else 'HAVING count(*) > 0'}
      UNION ALL SELECT recent_days, {lead}{aggs} FROM {many} GROUP BY ALL)"""


def orders(keys: str) -> str:
    return one_and_n("dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd", keys, COUNT_AMOUNT)


def receives(keys: str) -> str:
    return one_and_n("dws_trans_org_receive_1d", "dws_trans_org_receive_nd", keys,
                     f"{big('sum(order_count)')} AS receive_order_count, {dec('sum(order_amount)')} AS receive_order_amount")


def delivers(keys: str) -> str:
    return one_and_n("dws_trans_org_deliver_suc_1d", "dws_trans_org_deliver_suc_nd", keys, f"{big('sum(order_count)')} AS deliver_suc_count")


def sorts(keys: str) -> str:
    return one_and_n("dws_trans_org_sort_1d", "dws_trans_org_sort_nd", keys, f"{big('sum(sort_count)')} AS sort_count")


def full(frames: list[tuple[str, str]], keys: list[str]) -> str:
    """Every key of any frame once, and each frame looked up by it; null keys compare equal."""
    every = " UNION ".join(f"SELECT {', '.join(keys)} FROM {f}" for f, _ in frames)
    on = [" AND ".join(f"k.{c} IS NOT DISTINCT FROM t{i}.{c}" for c in keys) for i in range(len(frames))]
    joins = " ".join(f"LEFT JOIN {f} t{i} ON {on[i]}" for i, (f, _) in enumerate(frames))
    return f"SELECT {', '.join('k.' + c for c in keys)}, {', '.join(c for _, c in frames)}, {D} AS dt FROM ({every}) k {joins}"


def express(keys: str) -> str:
    return full([(delivers(keys), "deliver_suc_count"), (sorts(keys), "sort_count"), (receives(keys), "receive_order_count, receive_order_amount")],
                ["recent_days", *keys.split(", ")])


TRANS_NAMES = "trans_finish_count, trans_finish_distance, trans_finish_dur_sec, avg_trans_finish_distance, avg_trans_finish_dur_sec"

VIEWS = {
    "dim_complex_full": f"""SELECT x.id, complex_name, province_id, city_id, district_id, district_name, p.name AS province_name, c.name AS city_name, e.ids AS courier_emp_ids, {D} AS dt
        FROM {live('ods_base_complex')} x JOIN {live('ods_base_region_info')} p ON p.id = x.province_id JOIN {live('ods_base_region_info')} c ON c.id = x.city_id
        LEFT JOIN (SELECT complex_id, string_agg(e, ';' ORDER BY e) AS ids FROM (SELECT DISTINCT complex_id, CAST(courier_emp_id AS VARCHAR) AS e FROM {live('ods_express_courier_complex')}) GROUP BY 1) e ON e.complex_id = x.id""",
    "dim_organ_full": f"""SELECT o.*, r.name AS region_name, r.dict_code AS region_code, p.org_name AS org_parent_name, {D} AS dt FROM {live('ods_base_organ')} o
        LEFT JOIN {live('ods_base_region_info')} r ON r.id = o.region_id LEFT JOIN {live('ods_base_organ')} p ON p.id = o.org_parent_id""",
    "dim_region_full": f"SELECT *, {D} AS dt FROM {live('ods_base_region_info')}",
    "dim_express_courier_full": f"""SELECT e.* REPLACE (md5(working_phone) AS working_phone), org_name, d.name AS express_type_name, {D} AS dt FROM {live('ods_express_courier')} e
        JOIN {live('ods_base_organ')} o ON o.id = e.org_id JOIN {DIC} d ON CAST(d.id AS VARCHAR) = express_type""",
    "dim_shift_full": f"""SELECT s.*, l.name AS line_name, l.* EXCLUDE (id, name, start_time), d.name AS transport_line_type_name, {D} AS dt FROM {live('ods_line_base_shift')} s
        JOIN (SELECT *, NULL AS start_time FROM {live('ods_line_base_info')}) l ON l.id = s.line_id JOIN {DIC} d ON CAST(d.id AS VARCHAR) = transport_line_type_id""",
    "dim_truck_driver_full": f"""SELECT d.*, org_name, t.name AS team_name, {D} AS dt FROM {live('ods_truck_driver')} d JOIN {live('ods_base_organ')} o ON o.id = d.org_id
        JOIN {live('ods_truck_team')} t ON t.id = d.team_id""",
    "dim_truck_full": f"""SELECT k.* REPLACE (md5(truck_no) AS truck_no), t.name AS team_name, team_no, t.org_id, org_name, manager_emp_id, model_name AS truck_model_name, model_type AS truck_model_type,
        dt.name AS truck_model_type_name, model_no AS truck_model_no, brand AS truck_brand, db.name AS truck_brand_name, truck_weight, load_weight, total_weight, eev, boxcar_len, boxcar_wd,
        boxcar_hg, max_speed, oil_vol, {D} AS dt FROM {live('ods_truck_info')} k JOIN {live('ods_truck_team')} t ON t.id = k.team_id JOIN {live('ods_truck_model')} m ON m.id = k.truck_model_id
        JOIN {live('ods_base_organ')} o ON o.id = t.org_id JOIN {DIC} dt ON CAST(dt.id AS VARCHAR) = model_type JOIN {DIC} db ON CAST(db.id AS VARCHAR) = brand""",
    "dim_user_zip": f"""SELECT id, login_name, nick_name, md5(passwd) AS passwd, md5(real_name) AS real_name, md5(CASE WHEN regexp_matches(phone_num, '{STRICT}') THEN phone_num END) AS phone_num,
        md5(CASE WHEN regexp_matches(email, '{MAIL}') THEN email END) AS email, user_level, strftime(DATE '1970-01-01' + CAST(birthday AS INTEGER), '%Y-%m-%d') AS birthday, gender,
        {utc('create_time', '%Y-%m-%d')} AS start_date, '9999-12-31' AS end_date, {D} AS dt FROM {live('ods_user_info')}""",
    "dim_user_address_zip": f"""SELECT * EXCLUDE (create_time) REPLACE (md5(CASE WHEN regexp_matches(phone, '{STRICT}') THEN phone END) AS phone), {iso('create_time')} AS start_date,
        '9999-12-31' AS end_date, {D} AS dt FROM {live('ods_user_address')}""",
    "dwd_trade_order_detail_inc": facts("order_time", cargo=True, pay=False),
    "dwd_trade_pay_suc_detail_inc": facts("payment_time", deny("60010", "60999")),
    "dwd_trade_order_cancel_detail_inc": facts("cancel_time", "o.status = '60020'"),
    "dwd_trans_receive_detail_inc": facts("receive_time", deny("60010", "60020", "60999")),
    "dwd_trans_dispatch_detail_inc": facts("dispatch_time", deny("60010", "60020", "60030", "60040", "60999")),
    "dwd_trans_bound_finish_detail_inc": facts("bound_finish_time", deny("60020", "60030", "60040", "60050")),
    "dwd_trans_deliver_suc_detail_inc": facts("deliver_suc_time", deny("60020", "60030", "60040")),
    "dwd_trans_sign_detail_inc": facts("sign_time", deny("60020", "60030", "60040", "60050")),
    "dwd_trade_order_process_inc": facts(
        "order_time", cargo=True, extra=", substr(c.create_time, 1, 10) AS start_date, CASE WHEN o.status IN ('60020', '60030') THEN substr(o.update_time, 1, 10) ELSE '9999-12-31' END AS end_date",
        dt="CASE WHEN o.status IN ('60020', '60030') THEN substr(o.update_time, 1, 10) ELSE '9999-12-31' END"),
    "dwd_trans_trans_finish_inc": f"""SELECT t.* REPLACE (substr(driver1_name, 1, 1) || '*' AS driver1_name, substr(driver2_name, 1, 1) || '*' AS driver2_name, md5(truck_no) AS truck_no,
        {utc('actual_start_time')} AS actual_start_time, {utc('actual_end_time')} AS actual_end_time),
        (CAST(actual_end_time AS BIGINT) - CAST(actual_start_time AS BIGINT)) // 1000 AS finish_dur_sec, {utc('actual_end_time', '%Y-%m-%d')} AS dt
        FROM {live('ods_transport_task')} t WHERE actual_end_time IS NOT NULL""",
    "dwd_bound_inbound_inc": bound("inbound_time", "inbound_emp_id"),
    "dwd_bound_sort_inc": bound("sort_time", "sorter_emp_id"),
    "dwd_bound_outbound_inc": bound("outbound_time", "outbound_emp_id"),
    "dws_trade_org_cargo_type_order_1d": f"""WITH o AS (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, dt, max(amount) AS amount FROM dwd_trade_order_detail_inc GROUP BY ALL),
        a AS (SELECT g.id AS org_id, g.org_name, CAST(sender_city_id AS BIGINT) AS city_id, cargo_type, cargo_type_name, o.dt, count(*) AS order_count, {dec('sum(amount)')} AS order_amount
          FROM o LEFT JOIN dim_organ_full g ON CAST(g.region_id AS VARCHAR) = sender_district_id GROUP BY ALL)
        SELECT a.*, r.name AS city_name FROM a LEFT JOIN dim_region_full r ON r.id = city_id""",
    "dws_trans_org_receive_1d": f"""WITH o AS (SELECT order_id, sender_district_id, dt, max(amount) AS amount FROM dwd_trans_receive_detail_inc GROUP BY ALL)
        SELECT {WALKED}, o.dt, count(*) AS order_count, {dec('sum(amount)')} AS order_amount FROM o {WALK.format('sender_district_id')} GROUP BY ALL""",
    "dws_trans_dispatch_1d": f"""SELECT dt, count(*) AS order_count, {dec('sum(a)')} AS order_amount FROM (SELECT order_id, dt, max(amount) AS a FROM dwd_trans_dispatch_detail_inc GROUP BY ALL) GROUP BY dt""",
    "dws_trans_org_truck_model_type_trans_finish_1d": f"""SELECT start_org_id AS org_id, start_org_name AS org_name, truck_model_type, truck_model_type_name, t.dt, count(*) AS trans_finish_count,
        {dec('sum(actual_distance)')} AS trans_finish_distance, {big('sum(finish_dur_sec)')} AS trans_finish_dur_sec FROM dwd_trans_trans_finish_inc t LEFT JOIN dim_truck_full k ON k.id = t.truck_id GROUP BY ALL""",
    "dws_trans_org_deliver_suc_1d": f"""WITH o AS (SELECT DISTINCT order_id, receiver_district_id, dt FROM dwd_trans_deliver_suc_detail_inc)
        SELECT {WALKED}, o.dt, count(*) AS order_count FROM o {WALK.format('receiver_district_id')} GROUP BY ALL""",
    "dws_trans_org_sort_1d": """SELECT a.org_id, a.dt, sort_count, g.org_name, CASE WHEN org_level = 1 THEN r1.id ELSE r2.id END AS city_id, CASE WHEN org_level = 1 THEN r1.name ELSE r2.name END AS city_name,
        CASE WHEN org_level = 1 THEN r2.id ELSE r3.id END AS province_id, CASE WHEN org_level = 1 THEN r2.name ELSE r3.name END AS province_name
        FROM (SELECT org_id, dt, count(*) AS sort_count FROM dwd_bound_sort_inc GROUP BY ALL) a LEFT JOIN dim_organ_full g ON g.id = a.org_id LEFT JOIN dim_region_full r1 ON r1.id = g.region_id
        LEFT JOIN dim_region_full r2 ON r2.id = r1.parent_id LEFT JOIN dim_region_full r3 ON r3.id = r2.parent_id""",
    "dws_trade_org_cargo_type_order_nd": nd("dws_trade_org_cargo_type_order_1d", "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name", COUNT_AMOUNT),
    "dws_trans_org_receive_nd": nd("dws_trans_org_receive_1d", PLACE, COUNT_AMOUNT),
    "dws_trans_dispatch_nd": nd("dws_trans_dispatch_1d", "", COUNT_AMOUNT),
    "dws_trans_shift_trans_finish_nd": f"""WITH a AS (SELECT recent_days, shift_id, line_id, truck_id, start_org_id AS org_id, start_org_name AS org_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name,
          count(*) AS trans_finish_count, {dec('sum(actual_distance)')} AS trans_finish_distance, {big('sum(finish_dur_sec)')} AS trans_finish_dur_sec, {big('sum(order_num)')} AS trans_finish_order_count
          FROM dwd_trans_trans_finish_inc, {N2} WHERE {IN_N} GROUP BY ALL)
        SELECT a.* EXCLUDE (truck_id), CASE WHEN org_level = 1 THEN r1.id ELSE r2.id END AS city_id, CASE WHEN org_level = 1 THEN r1.name ELSE r2.name END AS city_name, line_name, truck_model_type,
          truck_model_type_name, {D} AS dt FROM a LEFT JOIN dim_organ_full g ON g.id = a.org_id LEFT JOIN dim_region_full r1 ON r1.id = g.region_id LEFT JOIN dim_region_full r2 ON r2.id = r1.parent_id
          LEFT JOIN dim_shift_full s ON s.id = a.shift_id LEFT JOIN dim_truck_full k ON k.id = a.truck_id""",
    "dws_trans_org_deliver_suc_nd": nd("dws_trans_org_deliver_suc_1d", PLACE, f"{big('sum(order_count)')} AS order_count"),
    "dws_trans_org_sort_nd": nd("dws_trans_org_sort_1d", PLACE, f"{big('sum(sort_count)')} AS sort_count"),
    "dws_trans_dispatch_td": f"SELECT {COUNT_AMOUNT}, {D} AS dt FROM dws_trans_dispatch_1d WHERE dt <= {D}",
    "dws_trans_bound_finish_td": f"""SELECT count(*) AS order_count, {dec('sum(a)')} AS order_amount, {D} AS dt FROM
        (SELECT order_id, max(amount) AS a FROM dwd_trans_bound_finish_detail_inc WHERE dt <= {D} GROUP BY order_id)""",
    "ads_trans_order_stats": full([(receives(""), "receive_order_count, receive_order_amount"),
                                   (one_and_n("dws_trans_dispatch_1d", "dws_trans_dispatch_nd", "", f"{big('sum(order_count)')} AS dispatch_order_count, {dec('sum(order_amount)')} AS dispatch_order_amount"),
                                    "dispatch_order_count, dispatch_order_amount")], ["recent_days"]),
    "ads_trans_stats": f"SELECT *, {D} AS dt FROM {one_and_n(ONE_TRANS, N_TRANS, '', TRANS)}",
    "ads_trans_order_stats_td": f"""SELECT o.dt, o.order_count - f.order_count AS bounding_order_count, {dec('o.order_amount - f.order_amount')} AS bounding_order_amount
        FROM dws_trans_dispatch_td o, dws_trans_bound_finish_td f""",
    "ads_order_stats": f"SELECT *, {D} AS dt FROM {orders('')}",
    "ads_order_cargo_type_stats": f"SELECT *, {D} AS dt FROM {orders('cargo_type, cargo_type_name')}",
    "ads_city_stats": full([(orders("city_id, city_name"), "order_count, order_amount"),
                            (f"""(SELECT 1 AS recent_days, CASE WHEN org_level = 1 THEN r1.id ELSE r2.id END AS city_id, CASE WHEN org_level = 1 THEN r1.name ELSE r2.name END AS city_name, {TRANS}, {MEANS}
                               FROM {ONE_TRANS} t LEFT JOIN dim_organ_full g ON g.id = t.org_id LEFT JOIN dim_region_full r1 ON r1.id = g.region_id
                               LEFT JOIN dim_region_full r2 ON r2.id = r1.parent_id WHERE t.dt = {D} GROUP BY ALL
                               UNION ALL SELECT recent_days, city_id, city_name, {TRANS}, {MEANS} FROM {N_TRANS} GROUP BY ALL)""", TRANS_NAMES)], ["recent_days", "city_id", "city_name"]),
    "ads_org_stats": "SELECT * FROM (" + full([(orders("org_id, org_name"), "order_count, order_amount"),
                                               (one_and_n(ONE_TRANS, N_TRANS, "org_id, org_name", f"{TRANS}, {MEANS}"), TRANS_NAMES)], ["recent_days", "org_id", "org_name"])
                     + ") WHERE recent_days = 1 OR (order_count IS NOT NULL AND trans_finish_count IS NOT NULL)",
    "ads_shift_stats": f"SELECT dt, recent_days, shift_id, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, trans_finish_order_count FROM {N_TRANS}",
    "ads_line_stats": f"SELECT recent_days, line_id, line_name, {TRANS}, {big('sum(trans_finish_order_count)')} AS trans_finish_order_count, {D} AS dt FROM {N_TRANS} GROUP BY ALL",
    "ads_driver_stats": f"""WITH h AS (SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count,
          CAST(trans_finish_distance AS DECIMAL(20,4)) * (CASE WHEN driver2_emp_id IS NULL THEN 1.0 ELSE 0.5 END) AS trans_finish_distance,
          trans_finish_dur_sec / (CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END) AS trans_finish_dur_sec FROM {N_TRANS}
        UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, CAST(trans_finish_distance AS DECIMAL(20,4)) * 0.5, trans_finish_dur_sec / 2 FROM {N_TRANS} WHERE driver2_emp_id IS NOT NULL)
        SELECT recent_days, driver_emp_id, driver_name, {TRANS}, {MEANS}, {D} AS dt FROM h GROUP BY ALL""",
    "ads_truck_stats": f"SELECT recent_days, truck_model_type, truck_model_type_name, {TRANS}, {MEANS}, {D} AS dt FROM {N_TRANS} GROUP BY ALL",
    "ads_express_stats": full([(delivers(""), "deliver_suc_count"), (sorts(""), "sort_count")], ["recent_days"]),
    "ads_express_province_stats": express("province_id, province_name"),
    "ads_express_city_stats": express("city_id, city_name"),
    "ads_express_org_stats": express("org_id, org_name"),
}
