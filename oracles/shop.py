"""Views that rebuild every shop table in DuckDB, one per job; a check joins the views it needs."""

from oracles.operators import amt, big, dec

D = "'1998-06-30'"
N3 = "(VALUES (1), (7), (30)) n(recent_days)"
CUT = "strftime(DATE '1998-06-30' - recent_days, '%Y-%m-%d')"
LAST7, LAST30 = "dt > '1998-06-23' AND dt <= '1998-06-30'", "dt > '1998-05-31' AND dt <= '1998-06-30'"
SKU = "sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name"
CATE = "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"
PROV = "province_name, area_code, iso_code, iso_3166_2"
SUMS = ", ".join(f"{dec(f'sum({s})')} AS {n}" for n, s in [
    ("order_original_amount_1d", "split_original_amount"), ("activity_reduce_amount_1d", "split_activity_amount"),
    ("coupon_reduce_amount_1d", "split_coupon_amount"), ("order_total_amount_1d", "split_total_amount")])
STRICT = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
MAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def masked(table: str) -> str:
    return f"""SELECT id, substr(name, 1, 1) || '*' AS name, CASE WHEN regexp_matches(phone_num, '{STRICT}') THEN substr(phone_num, 1, 3) || '*' END AS phone_num,
      CASE WHEN regexp_matches(email, '{MAIL}') THEN '*@' || split_part(email, '@', 2) END AS email, user_level, birthday, gender, create_time, operate_time FROM {table}"""


LOCAL = "make_timestamp(CAST(log ->> '$.ts' AS BIGINT) * 1000) + INTERVAL 8 HOUR"
DEV = "channel, province_id, version_code, mid_id, brand, model, operate_system"
COMMON = ", ".join(f"log ->> '$.common.{k}' AS {n}" for n, k in [
    ("province_id", "ar"), ("brand", "ba"), ("channel", "ch"), ("is_new", "is_new"), ("model", "md"), ("mid_id", "mid"), ("operate_system", "os"),
    ("user_id", "uid"), ("version_code", "vc"), ("session_id", "sid")])


def nd(source: str, keys: str, measures: list[str]) -> str:
    cols = []
    for days, cond in ((7, LAST7), (30, LAST30)):
        for m in measures:
            x = f"coalesce(sum({m}) FILTER ({cond}), 0)"
            cols.append(f"{dec(x) if 'amount' in m else big(x)} AS {m[:-3]}_{days}d")
    return f"SELECT {keys}, {', '.join(cols)}, {D} AS dt FROM {source} WHERE {LAST30} GROUP BY {keys}"


AMOUNTS_1D = ["order_original_amount_1d", "activity_reduce_amount_1d", "coupon_reduce_amount_1d", "order_total_amount_1d"]
TD = f"""SELECT user_id, min(dt) AS order_date_first, max(dt) AS order_date_last, {big('sum(order_count_1d)')} AS order_count_td,
  {big('sum(order_num_1d)')} AS order_num_td, {dec('sum(order_original_amount_1d)')} AS original_amount_td,
  {dec('sum(activity_reduce_amount_1d)')} AS activity_reduce_amount_td, {dec('sum(coupon_reduce_amount_1d)')} AS coupon_reduce_amount_td,
  {dec('sum(order_total_amount_1d)')} AS total_amount_td, {D} AS dt FROM dws_trade_user_order_1d WHERE dt <= {D} GROUP BY user_id"""


def stats(keys: str) -> str:
    return f"""SELECT recent_days, {keys}, {big('sum(order_count_1d)')} AS order_count, count(DISTINCT user_id) AS order_user_count, {D} AS dt
      FROM dws_trade_user_sku_order_1d, {N3} WHERE dt > {CUT} AND dt <= {D} GROUP BY recent_days, {keys}"""


VIEWS = {
    "dim_sku_full": f"""SELECT s.*, spu_name, c3.name AS category3_name, c3.category2_id, c2.name AS category2_name, c2.category1_id,
        c1.name AS category1_name, tm_name, a.txt AS sku_attr_values, b.txt AS sku_sale_attr_values, {D} AS dt
        FROM ods_sku_info s LEFT JOIN ods_spu_info p ON p.id = s.spu_id LEFT JOIN ods_base_category3 c3 ON c3.id = s.category3_id
        LEFT JOIN ods_base_category2 c2 ON c2.id = c3.category2_id LEFT JOIN ods_base_category1 c1 ON c1.id = c2.category1_id
        LEFT JOIN ods_base_trademark t ON t.id = s.tm_id
        LEFT JOIN (SELECT sku_id, string_agg(attr_id || ',' || value_id || ',' || attr_name || ',' || value_name, ';' ORDER BY attr_id) AS txt FROM ods_sku_attr_value GROUP BY 1) a ON a.sku_id = s.id
        LEFT JOIN (SELECT sku_id, string_agg(sale_attr_id || ',' || sale_attr_value_id || ',' || sale_attr_name || ',' || sale_attr_value_name, ';' ORDER BY sale_attr_id) AS txt FROM ods_sku_sale_attr_value GROUP BY 1) b ON b.sku_id = s.id""",
    "dim_coupon_full": f"""SELECT c.id, coupon_name, coupon_type AS coupon_type_code, t.dic_name AS coupon_type_name, condition_amount, condition_num, activity_id,
        benefit_amount, benefit_discount, CASE coupon_type WHEN '3201' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
          WHEN '3202' THEN '满' || condition_num || '件打' || benefit_discount || ' 折' WHEN '3203' THEN '减' || benefit_amount || '元' END AS benefit_rule,
        create_time, range_type AS range_type_code, r.dic_name AS range_type_name, limit_num, taken_count, start_time, end_time, operate_time, expire_time, {D} AS dt
        FROM ods_coupon_info c LEFT JOIN ods_base_dic t ON t.dic_code = coupon_type AND t.parent_code = '32'
        LEFT JOIN ods_base_dic r ON r.dic_code = range_type AND r.parent_code = '33'""",
    "dim_activity_full": f"""SELECT r.id AS activity_rule_id, r.activity_id, activity_name, r.activity_type AS activity_type_code, dic_name AS activity_type_name,
        activity_desc, start_time, end_time, create_time, condition_amount, condition_num, benefit_amount, benefit_discount,
        CASE r.activity_type WHEN '3101' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
          WHEN '3102' THEN '满' || condition_num || '件打' || benefit_discount || ' 折' WHEN '3103' THEN '打' || benefit_discount || '折' END AS benefit_rule,
        benefit_level, {D} AS dt FROM ods_activity_rule r LEFT JOIN ods_activity_info i ON i.id = r.activity_id
        LEFT JOIN ods_base_dic d ON d.dic_code = r.activity_type AND d.parent_code = '31'""",
    "dim_province_full": f"""SELECT p.id, name AS province_name, area_code, iso_code, iso_3166_2, region_id, region_name, {D} AS dt
        FROM ods_base_province p LEFT JOIN ods_base_region r ON r.id = p.region_id""",
    "dim_promotion_pos_full": f"SELECT *, {D} AS dt FROM ods_promotion_pos",
    "dim_promotion_refer_full": f"SELECT *, {D} AS dt FROM ods_promotion_refer",
    "dim_user_zip_init": f"SELECT *, substr(create_time, 1, 10) AS start_date, '9999-12-31' AS end_date FROM ({masked('ods_user_info')})",
    "dim_user_zip": f"""SELECT o.*, '1998-06-29' AS dt FROM (SELECT o.* REPLACE ('1998-06-29' AS end_date) FROM dim_user_zip_init o SEMI JOIN ods_user_info_inc n ON n.id = o.id) o
        UNION ALL SELECT o.*, '9999-12-31' FROM dim_user_zip_init o ANTI JOIN ods_user_info_inc n ON n.id = o.id
        UNION ALL SELECT *, {D}, '9999-12-31', '9999-12-31' FROM ({masked('ods_user_info_inc')})""",
    "dwd_trade_cart_add_inc": "SELECT id, user_id, sku_id, substr(create_time, 1, 10) AS date_id, create_time, sku_num, substr(create_time, 1, 10) AS dt FROM ods_cart_info",
    "dwd_trade_order_detail_inc": f"""SELECT d.id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, substr(d.create_time, 1, 10) AS date_id,
        d.create_time, sku_num, {amt('sku_num * order_price')} AS split_original_amount, {amt('coalesce(split_activity_amount, 0)')} AS split_activity_amount,
        {amt('coalesce(split_coupon_amount, 0)')} AS split_coupon_amount, split_total_amount, substr(d.create_time, 1, 10) AS dt
        FROM ods_order_detail d LEFT JOIN ods_order_info o ON o.id = d.order_id LEFT JOIN ods_order_detail_activity a ON a.order_detail_id = d.id
        LEFT JOIN ods_order_detail_coupon c ON c.order_detail_id = d.id""",
    "dwd_trade_pay_detail_suc_inc": f"""SELECT d.id, d.order_id, p.user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, payment_type AS payment_type_code,
        dic_name AS payment_type_name, substr(callback_time, 1, 10) AS date_id, callback_time, sku_num, {amt('sku_num * order_price')} AS split_original_amount,
        {amt('coalesce(split_activity_amount, 0)')} AS split_activity_amount, {amt('coalesce(split_coupon_amount, 0)')} AS split_coupon_amount,
        split_total_amount AS split_payment_amount, substr(callback_time, 1, 10) AS dt
        FROM ods_order_detail d JOIN ods_payment_info p ON p.order_id = d.order_id LEFT JOIN ods_order_info o ON o.id = d.order_id
        LEFT JOIN ods_order_detail_activity a ON a.order_detail_id = d.id LEFT JOIN ods_order_detail_coupon c ON c.order_detail_id = d.id
        LEFT JOIN ods_base_dic b ON b.dic_code = payment_type AND b.parent_code = '11'""",
    "dwd_trade_cart_full": f"SELECT id, user_id, sku_id, sku_name, sku_num, {D} AS dt FROM ods_cart_info WHERE is_ordered = '0'",
    "dwd_trade_trade_flow_acc": f"""WITH f AS (SELECT o.id AS order_id, o.user_id, province_id, substr(create_time, 1, 10) AS order_date_id, create_time AS order_time,
          CASE WHEN callback_time < '1998-07-01' THEN callback_time END AS payment_time, CASE WHEN operate_time < '1998-07-01' THEN operate_time END AS finish_time,
          original_total_amount AS order_original_amount, activity_reduce_amount AS order_activity_amount, coupon_reduce_amount AS order_coupon_amount,
          o.total_amount AS order_total_amount, CASE WHEN callback_time < '1998-07-01' THEN p.total_amount END AS pay
          FROM ods_order_info o LEFT JOIN ods_payment_info p ON p.order_id = o.id
          LEFT JOIN ods_order_status_log l ON l.order_id = o.id AND l.order_status = '1004' WHERE create_time < '1998-07-01')
        SELECT * EXCLUDE (pay), substr(payment_time, 1, 10) AS payment_date_id, substr(finish_time, 1, 10) AS finish_date_id, {amt('coalesce(pay, 0)')} AS payment_amount,
          coalesce(substr(finish_time, 1, 10), '9999-12-31') AS dt FROM f WHERE finish_time IS NULL OR finish_time >= {D}""",
    "dwd_tool_coupon_used_inc": "SELECT id, coupon_id, user_id, order_id, substr(used_time, 1, 10) AS date_id, used_time AS payment_time, substr(used_time, 1, 10) AS dt FROM ods_coupon_use WHERE used_time IS NOT NULL",
    "dwd_interaction_favor_add_inc": "SELECT id, user_id, sku_id, substr(create_time, 1, 10) AS date_id, create_time, substr(create_time, 1, 10) AS dt FROM ods_favor_info",
    "dwd_traffic_page_view_inc": f"""SELECT {COMMON}, log ->> '$.page.item' AS page_item, log ->> '$.page.item_type' AS page_item_type, log ->> '$.page.last_page_id' AS last_page_id,
        log ->> '$.page.page_id' AS page_id, log ->> '$.page.from_pos_id' AS from_pos_id, log ->> '$.page.from_pos_seq' AS from_pos_seq, log ->> '$.page.refer_id' AS refer_id,
        strftime({LOCAL}, '%Y-%m-%d') AS date_id, strftime({LOCAL}, '%Y-%m-%d %H:%M:%S') AS view_time, CAST(log ->> '$.page.during_time' AS BIGINT) AS during_time,
        CAST(log ->> '$.ts' AS BIGINT) AS ts, strftime({LOCAL}, '%Y-%m-%d') AS dt FROM ods_z_log WHERE (log -> '$.page') IS NOT NULL""",
    "dwd_user_register_inc": f"""SELECT u.id AS user_id, substr(create_time, 1, 10) AS date_id, create_time, {DEV}, substr(create_time, 1, 10) AS dt FROM ods_user_info u
        LEFT JOIN (SELECT user_id, {DEV} FROM dwd_traffic_page_view_inc WHERE page_id = 'register' AND user_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) = 1) v ON v.user_id = u.id""",
    "dwd_user_login_inc": f"""SELECT user_id, date_id, view_time AS login_time, {DEV}, dt FROM dwd_traffic_page_view_inc WHERE user_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts) = 1""",
    "dws_trade_user_sku_order_1d": f"""SELECT g.*, {SKU} FROM (SELECT user_id, sku_id, dt, count(*) AS order_count_1d, {big('sum(sku_num)')} AS order_num_1d, {SUMS}
        FROM dwd_trade_order_detail_inc GROUP BY ALL) g LEFT JOIN dim_sku_full k ON k.id = g.sku_id""",
    "dws_trade_user_order_1d": f"""SELECT user_id, dt, count(DISTINCT order_id) AS order_count_1d, {big('sum(sku_num)')} AS order_num_1d, {SUMS} FROM dwd_trade_order_detail_inc GROUP BY ALL""",
    "dws_trade_user_cart_add_1d": f"SELECT user_id, dt, count(*) AS cart_add_count_1d, {big('sum(sku_num)')} AS cart_add_num_1d FROM dwd_trade_cart_add_inc GROUP BY ALL",
    "dws_trade_province_order_1d": f"""SELECT g.*, {PROV} FROM (SELECT province_id, dt, count(DISTINCT order_id) AS order_count_1d, {SUMS} FROM dwd_trade_order_detail_inc GROUP BY ALL) g
        LEFT JOIN dim_province_full p ON p.id = g.province_id""",
    "dws_interaction_sku_favor_add_1d": f"""SELECT g.*, {SKU} FROM (SELECT sku_id, dt, count(*) AS favor_add_count_1d FROM dwd_interaction_favor_add_inc GROUP BY ALL) g
        LEFT JOIN dim_sku_full k ON k.id = g.sku_id""",
    "dws_traffic_session_page_view_1d": f"""SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt, {big('sum(during_time)')} AS during_time_1d,
        count(*) AS page_count_1d FROM dwd_traffic_page_view_inc GROUP BY ALL""",
    "dws_user_user_login_td_init": f"""SELECT id AS user_id, coalesce(l.last, substr(create_time, 1, 10)) AS login_date_last, substr(create_time, 1, 10) AS login_date_first,
        coalesce(n, 1) AS login_count_td FROM ods_user_info LEFT JOIN (SELECT user_id, max(dt) AS last, count(*) AS n FROM dwd_user_login_inc WHERE dt < {D} GROUP BY 1) l ON l.user_id = id""",
    "dws_user_user_login_td": f"""SELECT coalesce(o.user_id, n.user_id) AS user_id, CASE WHEN n.user_id IS NULL THEN login_date_last ELSE {D} END AS login_date_last,
        coalesce(login_date_first, {D}) AS login_date_first, coalesce(login_count_td, 0) + coalesce(n.c, 0) AS login_count_td, {D} AS dt
        FROM dws_user_user_login_td_init o FULL JOIN (SELECT user_id, count(*) AS c FROM dwd_user_login_inc WHERE dt = {D} GROUP BY 1) n ON n.user_id = o.user_id""",
    "dws_traffic_page_visitor_page_view_1d": f"""SELECT mid_id, brand, model, operate_system, page_id, dt, {big('sum(during_time)')} AS during_time_1d, count(*) AS view_count_1d
        FROM dwd_traffic_page_view_inc GROUP BY ALL""",
    "dws_trade_user_payment_1d": f"""SELECT user_id, dt, count(DISTINCT order_id) AS payment_count_1d, {big('sum(sku_num)')} AS payment_num_1d, {dec('sum(split_payment_amount)')} AS payment_amount_1d
        FROM dwd_trade_pay_detail_suc_inc GROUP BY ALL""",
    "dws_trade_user_order_td": TD,
    "dws_trade_user_order_td_outer": TD,
    "dws_trade_user_order_td_rebuild": TD,
    "dws_trade_user_sku_order_nd": nd("dws_trade_user_sku_order_1d", f"user_id, sku_id, {SKU}", ["order_count_1d", "order_num_1d", *AMOUNTS_1D]),
    "dws_trade_province_order_nd": nd("dws_trade_province_order_1d", f"province_id, {PROV}", ["order_count_1d", *AMOUNTS_1D]),
    "dws_tool_user_coupon_coupon_used_1d": """SELECT g.*, coupon_name, coupon_type_code, coupon_type_name, benefit_rule FROM
        (SELECT user_id, coupon_id, dt, count(*) AS used_count_1d FROM dwd_tool_coupon_used_inc GROUP BY ALL) g LEFT JOIN dim_coupon_full c ON c.id = g.coupon_id""",
    "ads_traffic_stats_by_channel": f"""SELECT recent_days, channel, count(DISTINCT mid_id) AS uv_count, {big('trunc(avg(during_time_1d) / 1000)')} AS avg_duration_sec,
        {big('trunc(avg(page_count_1d))')} AS avg_page_count, count(*) AS sv_count, CAST(count(*) FILTER (page_count_1d = 1) / count(*) AS DECIMAL(16,2)) AS bounce_rate, {D} AS dt
        FROM dws_traffic_session_page_view_1d, {N3} WHERE dt > {CUT} AND dt <= {D} GROUP BY recent_days, channel""",
    "ads_page_path": f"""WITH s AS (SELECT page_id p, row_number() OVER w rn, lead(page_id) OVER w nx FROM dwd_traffic_page_view_inc WHERE dt = {D}
          WINDOW w AS (PARTITION BY session_id ORDER BY ts, page_item))
        SELECT 'step-' || rn || ':' || p AS source, coalesce('step-' || (rn + 1) || ':' || nx, 'null') AS target, count(*) AS path_count, {D} AS dt FROM s GROUP BY ALL""",
    "ads_user_change": f"""SELECT {D} AS dt, (SELECT count(*) FROM dws_user_user_login_td WHERE login_date_last = '1998-06-23') AS user_churn_count,
        (SELECT count(*) FROM dws_user_user_login_td t JOIN dws_user_user_login_td_init y USING (user_id)
         WHERE t.login_date_last = {D} AND CAST({D} AS DATE) - CAST(y.login_date_last AS DATE) >= 8) AS user_back_count""",
    "ads_user_retention": f"""SELECT login_date_first AS create_date, CAST(DATE '1998-06-30' - CAST(login_date_first AS DATE) AS INTEGER) AS retention_day,
        count(*) FILTER (login_date_last = {D}) AS retention_count, count(*) AS new_user_count,
        CAST(count(*) FILTER (login_date_last = {D}) / count(*) * 100 AS DECIMAL(16,2)) AS retention_rate, {D} AS dt
        FROM dws_user_user_login_td WHERE login_date_first >= '1998-06-23' AND login_date_first < {D} GROUP BY login_date_first""",
    "ads_user_stats": f"""SELECT recent_days, count(*) FILTER (login_date_first > {CUT}) AS new_user_count, count(*) AS active_user_count, {D} AS dt
        FROM dws_user_user_login_td, {N3} WHERE login_date_last > {CUT} GROUP BY recent_days""",
    "ads_user_action": f"""SELECT {D} AS dt, (SELECT count(*) FROM dws_traffic_page_visitor_page_view_1d WHERE dt = {D} AND page_id = 'home') AS home_count,
        (SELECT count(*) FROM dws_traffic_page_visitor_page_view_1d WHERE dt = {D} AND page_id = 'good_detail') AS good_detail_count,
        (SELECT count(*) FROM dws_trade_user_cart_add_1d WHERE dt = {D}) AS cart_count, (SELECT count(*) FROM dws_trade_user_order_1d WHERE dt = {D}) AS order_count,
        (SELECT count(*) FROM dws_trade_user_payment_1d WHERE dt = {D}) AS payment_count""",
    "ads_new_order_user_stats": f"""SELECT recent_days, count(*) AS new_order_user_count, {D} AS dt FROM dws_trade_user_order_td, {N3} WHERE order_date_first > {CUT} GROUP BY recent_days""",
    "ads_order_continuously_user_count": f"""SELECT {D} AS dt, 7 AS recent_days, count(DISTINCT a.user_id) AS order_continuously_user_count
        FROM dws_trade_user_order_1d a JOIN dws_trade_user_order_1d b ON a.user_id = b.user_id AND CAST(b.dt AS DATE) = CAST(a.dt AS DATE) + 1
        JOIN dws_trade_user_order_1d c ON a.user_id = c.user_id AND CAST(c.dt AS DATE) = CAST(a.dt AS DATE) + 2 WHERE a.{LAST7.replace(' AND dt', ' AND c.dt')}""",
    "ads_repeat_purchase_by_tm": f"""SELECT tm_id, tm_name, CAST(count(*) FILTER (n >= 2) / count(*) AS DECIMAL(16,2)) AS order_repeat_rate, 30 AS recent_days, {D} AS dt
        FROM (SELECT user_id, tm_id, tm_name, sum(order_count_30d) AS n FROM dws_trade_user_sku_order_nd GROUP BY ALL) GROUP BY tm_id, tm_name""",
    "ads_order_stats_by_tm": stats("tm_id, tm_name"),
    "ads_order_stats_by_cate": stats(CATE),
    "ads_sku_cart_num_top3_by_cate": f"""SELECT sku_id, {big('cart_num')} AS cart_num, sku_name, {CATE}, CAST(rk AS INTEGER) AS rk, {D} AS dt FROM (SELECT c.*, sku_name, {CATE},
        rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS rk
        FROM (SELECT sku_id, sum(sku_num) AS cart_num FROM dwd_trade_cart_full GROUP BY 1) c LEFT JOIN dim_sku_full k ON k.id = c.sku_id) WHERE rk <= 3""",
    "ads_sku_favor_count_top3_by_tm": f"""SELECT tm_id, tm_name, sku_id, sku_name, favor_add_count_1d AS favor_count, CAST(rk AS INTEGER) AS rk, {D} AS dt FROM (SELECT *,
        rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS rk FROM dws_interaction_sku_favor_add_1d WHERE dt = {D}) WHERE rk <= 3""",
    "ads_order_to_pay_interval_avg": f"""SELECT {big("trunc(avg(date_diff('second', CAST(order_time AS TIMESTAMP), CAST(payment_time AS TIMESTAMP))))")} AS order_to_pay_interval_avg, {D} AS dt
        FROM dwd_trade_trade_flow_acc WHERE payment_time IS NOT NULL AND dt IN ('9999-12-31', {D})""",
    "ads_order_by_province": f"""SELECT 1 AS recent_days, province_id, {PROV}, order_count_1d AS order_count, order_total_amount_1d AS order_total_amount, {D} AS dt
          FROM dws_trade_province_order_1d WHERE dt = {D}
        UNION SELECT 7, province_id, {PROV}, order_count_7d, order_total_amount_7d, {D} FROM dws_trade_province_order_nd
        UNION SELECT 30, province_id, {PROV}, order_count_30d, order_total_amount_30d, {D} FROM dws_trade_province_order_nd""",
    "ads_coupon_stats": f"""SELECT coupon_id, coupon_name, {big('sum(used_count_1d)')} AS used_count, count(*) AS used_user_count, {D} AS dt
        FROM dws_tool_user_coupon_coupon_used_1d WHERE dt = {D} GROUP BY ALL""",
}
