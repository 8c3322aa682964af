"""SQL for the streaming queries."""

from oracles.operators import amt, big, dec

LINE_ID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER))"
US = "'%Y-%m-%d %H:%M:%S.%f'"
S = "'%Y-%m-%d %H:%M:%S'"
NAMES = "(VALUES (0, 'alipay'), (1, 'wechat'), (2, 'unionpay'), (3, 'card')) {0}(c, n)"
NEAR = "o_orderdate + INTERVAL 30 DAY >= l_shipdate AND o_orderdate - INTERVAL 30 DAY <= l_shipdate"
OP = "substr('rcud', CAST({0} % 4 AS INTEGER) + 1, 1)"
AMOUNT2 = f"CASE WHEN o_orderkey % 3 = 0 THEN {amt('o_totalprice')} + 10 ELSE {amt('o_totalprice')} END"
FIRSTS = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1"


def bounds(w: str, size: str) -> str:
    return f"strftime({w}, {S}) AS stt, strftime({w} + INTERVAL {size}, {S}) AS edt, strftime({w}, '%Y-%m-%d') AS cur_date"


def hour(ts: str = "ts") -> str:
    return f"date_trunc('hour', {ts})"


def epoch_bin(ts: str, days: int) -> str:
    return f"(TIMESTAMP '1970-01-01' + to_days(CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) // {days} * {days} AS INTEGER)))"


PAGES = f"""p AS (SELECT ts, 'v' || user_id % 3 AS vc, 'c' || user_id % 2 AS ch, event_type, 0 AS uv, 1 AS pv, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS sv,
    CAST(trunc(value * 100) AS BIGINT) AS dur FROM events
  UNION ALL SELECT ts, 'v' || user_id % 3, 'c' || user_id % 2, event_type, 1, 0, 0, 0 FROM ({FIRSTS}))"""


PAGE_VIEWS = f"""WITH {PAGES}, q AS (SELECT *, {hour()} AS w FROM p) SELECT {bounds('w', '1 HOUR')}, vc, ch, event_type, {big('sum(uv)')} AS uv_ct, {big('sum(sv)')} AS sv_ct,
  {big('sum(pv)')} AS pv_ct, {big('sum(dur)')} AS dur_sum FROM q GROUP BY w, vc, ch, event_type"""


SQL = {
    "parse_good": "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events WHERE event_id % 13 <> 0",
    "parse_dirty": "SELECT event_id, substr(props, 1, 4) AS props FROM events WHERE event_id % 13 = 0",
    "repair_is_new": """WITH f AS (SELECT user_id, arg_min(CASE WHEN event_id % 2 = 1 THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END, event_id) AS known FROM events GROUP BY 1)
        SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 AND CAST(ts AS DATE) = known THEN '1' ELSE '0' END AS is_new FROM events JOIN f USING (user_id)""",
    "split_log": """WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM events)
        SELECT 'err' AS kind, ms AS ts, event_id % 3 AS detail FROM e WHERE event_type = 'error' UNION ALL SELECT 'start', ms, user_id FROM e WHERE event_type = 'signup'
        UNION ALL SELECT 'display', ms, event_id % 10 FROM e WHERE event_type = 'view' UNION ALL SELECT 'display', ms, event_id % 7 FROM e WHERE event_type = 'view'
        UNION ALL SELECT 'action', ms, event_id % 5 FROM e WHERE event_type = 'click' UNION ALL SELECT 'page', ms, user_id FROM e WHERE event_type <> 'signup'""",
    "cdc_select": f"""SELECT o_orderkey AS id, o_custkey AS user_id, {dec('o_totalprice')} AS amount, strftime(o_orderdate, {US}) AS event_time FROM orders
        WHERE o_orderkey % 4 = 2 AND o_orderkey % 5 <> 0 AND o_orderstatus IN ('F', 'O') AND o_orderkey % 3 <> 0""",
    "cdc_envelope": f"""SELECT o_orderkey || '_' || (epoch_us(o_orderdate) // 1000) AS id, {OP.format('o_orderkey')} AS op, 'shop' AS db,
        CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE 'order_info' END AS "table", o_orderstatus AS status, epoch_us(o_orderdate) // 1000 AS ts FROM orders""",
    "cdc_delta": f"""WITH x AS (SELECT l_orderkey, {OP.format('l_partkey')} AS op, CAST(l_quantity AS BIGINT) AS q, l_linenumber * 7 AS b FROM lineitem),
        y AS (SELECT l_orderkey, CASE WHEN op = 'r' THEN q WHEN op = 'u' AND q > b THEN q - b END AS d FROM x)
        SELECT l_orderkey, {big('sum(d)')} AS gained, count(*) AS changes FROM y WHERE d IS NOT NULL GROUP BY l_orderkey""",
    "order_detail_stream": f"""SELECT {LINE_ID} AS id, l_orderkey AS order_id, o_custkey AS user_id, {amt('l_extendedprice')} AS amount,
        CASE WHEN l_discount > 0.05 THEN l_suppkey % 25 END AS activity_id, CASE WHEN l_tax > 0.04 THEN l_suppkey END AS coupon_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR}""",
    "cancel_stream": f"""SELECT {LINE_ID} AS id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id, {amt('l_extendedprice')} AS amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR} WHERE o_orderstatus = 'F'""",
    "interval_join": f"""SELECT a.event_id AS order_id, b.event_id AS pay_id, b.user_id AS pay_user, n AS pay_name FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click'
        AND b.event_type = 'purchase' AND a.ts >= b.ts - INTERVAL 30 MINUTE AND a.ts <= b.ts + INTERVAL 5 SECOND LEFT JOIN {NAMES.format('d')} ON c = b.event_id % 5""",
    "interval_merge": """SELECT a.event_id AS c_id, a.user_id AS c_user, b.event_id AS info_v_id, b.event_id % 5 AS info_v_code FROM events a JOIN events b ON a.user_id = b.user_id
        AND a.event_type = 'click' AND b.event_type = 'view' AND a.ts >= b.ts - INTERVAL 10 MINUTE AND a.ts <= b.ts + INTERVAL 10 MINUTE""",
    "refund_stream": f"""SELECT {LINE_ID} AS id, l_orderkey AS order_id, o_custkey AS user_id, t.n AS type_name, r.n AS reason_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR}
        LEFT JOIN {NAMES.format('t')} ON t.c = l_partkey % 5 LEFT JOIN {NAMES.format('r')} ON r.c = l_suppkey % 5 WHERE l_returnflag = 'R' AND o_orderstatus = 'F'""",
    "refund_paid_stream": f"""SELECT a.l_orderkey AS order_id, a.l_partkey AS sku_id, o_custkey AS user_id, b.l_linenumber AS refund_num, {dec('a.l_extendedprice')} AS paid, n AS pay_name
        FROM (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND {NEAR}) a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey
          AND a.l_shipdate BETWEEN b.l_shipdate - INTERVAL 30 DAY AND b.l_shipdate + INTERVAL 30 DAY
        LEFT JOIN {NAMES.format('d')} ON c = a.l_suppkey % 5 WHERE a.l_returnflag = 'R' AND b.l_linestatus = 'F'""",
    "lookup": "SELECT conv_id, turn, role, CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'agent' ELSE 'N/A' END AS role_name FROM conversations",
    "enrich_chain": """SELECT p_brand AS brand, r_name AS region, n_name AS nation, count(*) AS lines, max(s_name) AS last_supplier FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL""",
    "first_of_day": f"SELECT user_id, strftime(min(ts), {US}) AS ts FROM events GROUP BY user_id, CAST(ts AS DATE)",
    "retract_dedup": f"""WITH v AS (SELECT o_orderkey AS id, o_custkey % 25 AS province_id, strftime(o_orderdate, {US}) AS ts, {dec('o_totalprice')} AS one, {dec(AMOUNT2)} AS two FROM orders)
        SELECT id, province_id, ts, 1 AS version, one AS amount FROM v UNION ALL SELECT id, province_id, ts, 1, -one FROM v UNION ALL SELECT id, province_id, ts, 2, two FROM v""",
    "emit_last": f"""SELECT o_orderkey AS id, o_custkey % 25 AS province_id, strftime(o_orderdate, {US}) AS ts, 2 AS version, {dec(AMOUNT2)} AS amount FROM orders""",
    "keyword_counts": f"""WITH e AS (SELECT make_timestamp((conv_id * 60 + turn) * 1000000) AS ts, text FROM conversations),
        w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS w, unnest(list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'))) AS keyword FROM e)
        SELECT {bounds('w', '10 MINUTE')}, keyword, count(*) AS keyword_count FROM w WHERE keyword <> '' GROUP BY w, keyword""",
    "page_view_window": PAGE_VIEWS,
    "page_view_totals": PAGE_VIEWS,
    "unique_window": f"""WITH f AS (SELECT min(ts) AS ts FROM events WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE)), q AS (SELECT {hour()} AS w FROM f)
        SELECT {bounds('w', '1 HOUR')}, count(*) AS cart_add_uu_ct FROM q GROUP BY w""",
    "home_detail_window": f"""WITH f AS (SELECT event_type, min(ts) AS ts FROM events WHERE event_type IN ('view', 'click') GROUP BY event_type, user_id, CAST(ts AS DATE)), q AS (SELECT event_type, {hour()} AS w FROM f)
        SELECT {bounds('w', '1 HOUR')}, count(*) FILTER (event_type = 'view') AS home_uv_ct, count(*) FILTER (event_type = 'click') AS good_detail_uv_ct
        FROM q GROUP BY w""",
    "login_window_back": f"""WITH e AS (SELECT * FROM events WHERE event_type = 'purchase'), f AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS ts FROM e GROUP BY ALL),
        g AS (SELECT *, day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap FROM f), q AS (SELECT *, {hour()} AS w FROM g)
        SELECT {bounds('w', '1 HOUR')}, count(*) FILTER (gap >= 3) AS back_ct, count(*) AS uu_ct FROM q GROUP BY w""",
    "amount_window": f"""SELECT {bounds('o_orderdate', '1 DAY')}, o_custkey % 25 AS province_id, {dec(f'sum({AMOUNT2})')} AS order_amount FROM orders GROUP BY o_orderdate, o_custkey % 25""",
    "amount_window_upsert": f"""WITH q AS (SELECT *, {epoch_bin('l_shipdate', 30)} AS w FROM lineitem) SELECT {bounds('w', '30 DAY')}, l_partkey, {dec(f"sum({amt('l_extendedprice')})")} AS original_amount,
        {dec(f"sum(CAST({amt('l_extendedprice')} * {amt('l_discount')} AS DECIMAL(16,2)))")} AS activity_amount FROM q GROUP BY w, l_partkey""",
    "distinct_window": f"""WITH q AS (SELECT *, {epoch_bin('o_orderdate', 30)} AS w FROM orders) SELECT {bounds('w', '30 DAY')}, o_custkey % 25 AS province_id, count(DISTINCT o_orderkey) AS order_count,
        {dec(f"sum({amt('o_totalprice')} + {AMOUNT2})")} AS order_amount FROM q GROUP BY w, o_custkey % 25""",
    "newest_only": f"""SELECT o_orderkey, o_custkey, strftime(o_orderdate, {US}) AS ts FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM orders)
        WHERE best IS NULL OR o_orderdate > best""",
    "drop_repeats": f"SELECT event_id, strftime(ts, {US}) AS ts FROM events",
    "upsert_log": f"""SELECT o_custkey, o_orderkey, strftime(o_orderdate, {US}) AS o_orderdate, o_orderstatus FROM (SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE o_orderstatus <> 'P'""",
    "hand_over": """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, epoch_us(o_orderdate) // 1000 AS ms, o_orderkey AS k FROM orders)
        SELECT 'r' AS op, id, status, ms AS ts_ms FROM o UNION ALL SELECT 'u', id, status, ms + 1000 FROM o WHERE k % 5 = 0""",
    "dated_sink": f"""SELECT CASE WHEN event_id % 50 = 0 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, count(*) AS rows, {big('sum(event_id)')} AS id_sum FROM events GROUP BY 1""",
    "route_dims": """SELECT 'dim_user' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key, 'id=' || c_custkey || ';name=' || c_name AS cells FROM customer WHERE c_custkey % 10 <> 9
        UNION ALL SELECT 'dim_sku', CAST(p_partkey AS VARCHAR), 'extra=' || p_brand || ';id=' || p_partkey || ';name=' || p_name FROM part WHERE p_partkey % 10 <> 9""",
    "flag_words": """WITH x AS (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND role IN ('system', 'assistant') THEN role END AS w FROM conversations)
        SELECT conv_id, turn, CAST(w IS NOT NULL AS INTEGER) AS is_violation, CASE WHEN w IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade, coalesce(w, '') AS violation_msg FROM x""",
    "snake_json": """SELECT '{"supp_key":' || s_suppkey || ',"supplier_name":"' || s_name || '"}' AS value FROM supplier""",
}
