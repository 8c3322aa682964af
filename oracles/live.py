"""SQL for the real-time jobs."""

from oracles.operators import amt, big, dec
from oracles.streams import AMOUNT2, LINE_ID, NEAR, US, bounds, epoch_bin, hour
from oracles.views import duck_raw
from terrace.plans.raw_shop import DICTIONARY, EVENT_SHIFT_MS, RAW

DIC = f"dic AS ({DICTIONARY})"
SHIFT = f"INTERVAL {EVENT_SHIFT_MS // 86400000} DAY"
PAGE = f"""pg AS (SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'register' ELSE 'cart' END AS page_id,
  CASE WHEN event_id % 17 <> 0 THEN user_id END AS uid, event_id % 3 = 0 AS no_last, 1000 + event_id % 9000 AS during, date_trunc('millisecond', ts) - {SHIFT} AS ts FROM events WHERE event_type <> 'error')"""
STATUS = "CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1005' ELSE '1006' END"
CART = f"""cart AS (SELECT {LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id, l_shipdate,
  CAST(CASE WHEN l_partkey % 2 = 0 THEN l_quantity WHEN l_quantity > l_linenumber * 7 THEN l_quantity - l_linenumber * 7 END AS INTEGER) AS sku_num FROM lineitem)"""
SPLIT = f"CAST({amt('l_extendedprice')} * {amt('l_discount')} AS DECIMAL(16,2))"
TIME = "'%Y-%m-%d %H:%M:%S'"
DETAIL = f"""det AS (SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name, CAST(l_quantity AS BIGINT) AS sku_num,
  {SPLIT} AS split_activity_amount, {amt('0')} AS split_coupon_amount, {amt('l_extendedprice')} AS split_total_amount, {amt('CAST(l_quantity AS BIGINT) * ' + amt('l_extendedprice'))} AS split_original_amount,
  CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id, CASE WHEN l_discount > 0.05 THEN CAST(l_suppkey % 25 AS VARCHAR) END AS activity_id,
  CASE WHEN l_discount > 0.05 THEN CAST(l_suppkey AS VARCHAR) END AS activity_rule_id, CASE WHEN l_tax > 0.04 THEN CAST(l_suppkey AS VARCHAR) END AS coupon_id,
  strftime(l_shipdate, {TIME}) AS create_time, strftime(l_shipdate, '%Y-%m-%d') AS date_id, strftime(l_shipdate, {US}) AS detail_time, l_shipdate, o_orderdate, o_orderstatus, o_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR} WHERE l_partkey % 10 <> 0)"""
KEY = "CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id"
JOINED = "l_shipdate, o_orderdate, o_orderstatus, o_orderkey"


def js(*fields: tuple[str, str, bool]) -> str:
    """JSON text of (name, expression, quoted)."""
    return "'{' || " + " || ',' || ".join(f"'\"{n}\":' || " + (f"'\"' || {x} || '\"'" if q else x) for n, x, q in fields) + " || '}' AS value"


BOUNDS = [("stt", "stt", True), ("edt", "edt", True), ("cur_date", "cur_date", True)]
WEEK = epoch_bin("o_orderdate", 7)

SQL = {
    "log_splitter": f"""WITH e AS (SELECT *, date_trunc('millisecond', ts) - {SHIFT} AS moment, epoch_us(ts) // 1000 - {EVENT_SHIFT_MS} AS ms FROM events WHERE event_id % 20 <> 0),
        f AS (SELECT user_id, arg_min(CASE WHEN event_id % 2 = 1 THEN CAST(moment AS DATE) ELSE CAST(moment AS DATE) - 1 END, moment) AS known FROM e GROUP BY 1),
        g AS (SELECT e.*, CASE WHEN event_id % 2 = 1 AND CAST(moment AS DATE) = known THEN '1' ELSE '0' END AS flag FROM e JOIN f USING (user_id))
        SELECT 'page' AS kind, ms AS ts, flag AS detail, flag AS is_new FROM g WHERE event_id % 11 <> 0
        UNION ALL SELECT 'err', ms, CAST(event_id % 100 AS VARCHAR), NULL FROM g WHERE event_type = 'error'
        UNION ALL SELECT 'start', ms, CAST(event_id % 100 AS VARCHAR), flag FROM g WHERE event_id % 11 = 0
        UNION ALL SELECT 'display', ms, CAST(unnest([event_id % 10, event_id % 7]) AS VARCHAR), flag FROM g WHERE event_id % 11 <> 0 AND event_id % 4 = 1
        UNION ALL SELECT 'action', ms, CAST(event_id % 5 AS VARCHAR), flag FROM g WHERE event_id % 11 <> 0 AND event_id % 4 = 2
        UNION ALL SELECT 'dirty', NULL, substr(log, 1, 30), NULL FROM (SELECT id, log FROM ({duck_raw({'log': RAW['ods_z_log']})['log']}) WHERE id % 20 = 0)""",
    "dim_router": """WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS extra FROM customer), p AS (SELECT p_partkey AS k, p_name AS name, p_brand AS extra FROM part)
        SELECT 'dim_user' AS sink_table, CAST(k AS VARCHAR) AS row_key, 'id=' || k || ';name=' || name AS cells FROM c
        UNION ALL SELECT 'dim_buyer', CAST(k AS VARCHAR), 'extra=' || extra || ';id=' || k FROM c WHERE k % 2 = 0 AND k % 10 <> 0
        UNION ALL SELECT 'dim_sku', CAST(k AS VARCHAR), 'extra=' || extra || ';id=' || k || ';name=' || name FROM p""",
    "comment_fact": f"""WITH {DIC}, c AS (SELECT *, (conv_id + turn) % 3 = 0 AS changed, make_timestamp((conv_id * 100 + turn) * 1000000) AS moment FROM conversations WHERE (conv_id + turn) % 7 <> 0)
        SELECT conv_id || '-' || turn AS id, CAST(conv_id AS VARCHAR) AS user_id, CAST(turn AS VARCHAR) AS sku_id, dic_code AS appraise, CASE WHEN changed THEN text || ' (changed)' ELSE text END AS comment_txt,
        dic_name AS appraise_name, strftime(CASE WHEN changed THEN moment + INTERVAL 1 HOUR ELSE moment END, {US}) AS event_time FROM c JOIN dic ON CAST(dic_code AS BIGINT) = 1201 + turn % 4""",
    "cart_add_fact": f"WITH {CART} SELECT id, user_id, sku_id, sku_num, strftime(l_shipdate, {US}) AS event_time FROM cart WHERE sku_num IS NOT NULL",
    "order_detail_fact": f"WITH {DETAIL} SELECT * EXCLUDE ({JOINED}) FROM det",
    "order_cancel_fact": f"""WITH {DETAIL} SELECT * EXCLUDE ({JOINED}, create_time, date_id), strftime(o_orderdate, '%Y-%m-%d') AS date_id, strftime(o_orderdate, {TIME}) AS cancel_time FROM det WHERE o_orderstatus = 'F'""",
    "pay_success_fact": f"""WITH {DIC}, {DETAIL} SELECT det.* EXCLUDE ({JOINED}, create_time, date_id, detail_time, id, split_total_amount), id AS order_detail_id, split_total_amount AS split_payment_amount,
        dic_code AS payment_type_code, strftime(o_orderdate, '%Y-%m-%d') AS callback_time, strftime(o_orderdate, {US}) AS pay_time, dic_name AS payment_type_name
        FROM det JOIN dic ON CAST(dic_code AS BIGINT) = 1101 + o_orderkey % 4 WHERE o_orderstatus <> 'O' AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 5 SECOND""",
    "refund_fact": f"""WITH {DIC} SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id, a.dic_code AS refund_type_code, b.dic_code AS refund_reason_type_code, CAST(l_quantity AS BIGINT) AS refund_num,
        {amt('l_extendedprice')} AS refund_amount, strftime(l_shipdate, {US}) AS refund_time, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
        strftime(l_shipdate, {TIME}) AS create_time, 'reason ' || l_suppkey AS refund_reason_txt, a.dic_name AS refund_type_name, b.dic_name AS refund_reason_type_name, strftime(l_shipdate, '%Y-%m-%d') AS date_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR} JOIN dic a ON CAST(a.dic_code AS BIGINT) = 1101 + l_partkey % 4 JOIN dic b ON CAST(b.dic_code AS BIGINT) = 1201 + l_suppkey % 4
        WHERE l_returnflag = 'R' AND o_orderstatus = 'O'""",
    "refund_paid_fact": f"""WITH {DIC}, p AS (SELECT *, {LINE_ID} AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR} WHERE l_returnflag = 'R' AND l_partkey % 2 = 0 AND o_orderstatus = 'P')
        SELECT id, CAST(p.l_orderkey AS VARCHAR) AS order_id, CAST(p.l_partkey AS VARCHAR) AS sku_id, dic_code AS payment_type_code, {amt('p.l_extendedprice')} AS refund_amount, strftime(p.l_shipdate, {US}) AS pay_time,
        CAST(r.l_quantity AS BIGINT) AS refund_num, {KEY}, dic_name AS payment_type_name FROM p JOIN lineitem r ON r.l_orderkey = p.l_orderkey AND r.l_partkey = p.l_partkey AND r.l_returnflag = 'R' AND r.l_linestatus = 'F'
          AND p.l_shipdate BETWEEN r.l_shipdate - INTERVAL 30 DAY AND r.l_shipdate + INTERVAL 30 DAY JOIN dic ON CAST(dic_code AS BIGINT) = 1101 + p.l_partkey % 4""",
    "search_keywords": f"""WITH e AS (SELECT make_timestamp(conv_id * 1000000) AS ts, unnest(list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'))) AS keyword FROM conversations),
        q AS (SELECT *, time_bucket(INTERVAL 3 SECOND, ts, TIMESTAMP '1970-01-01') AS w FROM e WHERE keyword <> '') SELECT {bounds('w', '3 SECOND')}, keyword, count(*) AS keyword_count FROM q GROUP BY w, keyword""",
    "cart_unique_users": f"""WITH {CART}, f AS (SELECT DISTINCT user_id, l_shipdate FROM cart WHERE sku_num IS NOT NULL), q AS (SELECT {epoch_bin('l_shipdate', 7)} AS w FROM f)
        SELECT {bounds('w', '7 DAY')}, count(*) AS cart_add_uu_ct FROM q GROUP BY w""",
    "province_orders": f"""WITH q AS (SELECT *, {WEEK} AS w FROM orders), g AS (SELECT {bounds('w', '7 DAY')}, o_custkey % 25 AS k, count(*) AS c, {dec(f'sum({AMOUNT2})')} AS a FROM q GROUP BY w, o_custkey % 25)
        SELECT {js(*BOUNDS, ('province_id', 'k', True), ('order_count', 'c', False), ('order_amount', 'a', False), ('province_name', 'n_name', True))} FROM g JOIN nation ON n_nationkey = k""",
    "sku_orders": f"""WITH q AS (SELECT *, {WEEK} AS w FROM orders), g AS (SELECT {bounds('w', '7 DAY')}, o_custkey AS k, {dec(f'sum({AMOUNT2})')} AS a, {dec('count(*)')} AS c FROM q GROUP BY w, o_custkey)
        SELECT {js(*BOUNDS, ('sku_id', 'k', True), ('original_amount', 'a', False), ('activity_reduce_amount', "'0.00'", False), ('coupon_reduce_amount', 'c', False), ('order_amount', 'a', False),
                   ('sku_name', 'p_name', True), ('spu_id', 'p_partkey % 97', True), ('category3_id', 'p_size', True), ('trademark_id', 'substr(p_brand, 7)', True), ('spu_name', "'spu-' || p_partkey % 97", True),
                   ('trademark_name', 'p_brand', True), ('category3_name', "'leaf-' || p_size", True), ('category2_id', 'p_size % 10', True), ('category2_name', "'branch-' || p_size % 10", True),
                   ('category1_id', 'p_size % 10 % 3', True), ('category1_name', "'root-' || p_size % 10 % 3", True))} FROM g JOIN part ON p_partkey = k""",
    "home_detail_visitors": f"""WITH {PAGE}, f AS (SELECT page_id, min(ts) AS ts FROM pg WHERE page_id IN ('home', 'good_detail') GROUP BY page_id, user_id, CAST(ts AS DATE)), q AS (SELECT page_id, {hour()} AS w FROM f),
        g AS (SELECT {bounds('w', '1 HOUR')}, count(*) FILTER (page_id = 'home') AS h, count(*) FILTER (page_id = 'good_detail') AS d FROM q GROUP BY w)
        SELECT {js(*BOUNDS, ('home_uv_ct', 'h', False), ('good_detail_uv_ct', 'd', False))} FROM g""",
    "page_view_metrics": f"""WITH {PAGE}, v AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1 AS first, {hour()} AS w FROM pg),
        g AS (SELECT {bounds('w', '1 HOUR')}, 'v' || user_id % 3 AS vc, 'c' || user_id % 5 AS ch, user_id % 25 AS ar, event_id % 2 AS is_new, count(*) FILTER (first) AS u, count(*) FILTER (no_last) AS s, count(*) AS p, {big('sum(during)')} AS d
          FROM v GROUP BY w, user_id % 3, user_id % 5, user_id % 25, event_id % 2)
        SELECT {js(*BOUNDS, ('vc', 'vc', True), ('ch', 'ch', True), ('ar', 'ar', True), ('is_new', 'is_new', True), ('uv_ct', 'u', False), ('sv_ct', 's', False), ('pv_ct', 'p', False), ('dur_sum', 'd', False))} FROM g""",
    "login_users": f"""WITH {PAGE}, l AS (SELECT uid, ts FROM pg WHERE uid IS NOT NULL AND no_last), f AS (SELECT uid, CAST(ts AS DATE) AS day, min(ts) AS ts FROM l GROUP BY ALL),
        b AS (SELECT *, day - lag(day) OVER (PARTITION BY uid ORDER BY day) AS gap, {hour()} AS w FROM f),
        g AS (SELECT {bounds('w', '1 HOUR')}, count(*) FILTER (gap >= 8) AS b, count(*) AS u FROM b GROUP BY w)
        SELECT {js(*BOUNDS, ('back_ct', 'b', False), ('uu_ct', 'u', False))} FROM g""",
    "row_store": """WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'u' ELSE 'c' END AS op, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS name,
          (c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 10 ELSE 0 END) * 1000 AS ts FROM customer WHERE c_custkey % 10 <> 0)
        SELECT k || '_' || ts AS id, op, 'user_info' AS "table", name, ts FROM c""",
    "json_passthrough": """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS value FROM nation""",
}
