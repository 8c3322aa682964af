"""DuckDB statements that the batch operator queries are checked against."""


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def amt(x: str) -> str:
    return f"CAST({x} AS DECIMAL(16,2))"


D = "DATE '1998-06-30'"
E = "DATE '2024-01-20'"
LINES = """lines AS (SELECT l.*, o.*, p.p_brand, p.p_type, CAST(o.o_orderdate AS DATE) AS day
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""
N3 = "(VALUES (1), (7), (30)) n(recent_days)"


def recent(day: str, n: str = "recent_days", as_of: str = D) -> str:
    return f"{day} > {as_of} - {n} AND {day} <= {as_of}"


DAILY = f"""daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dt, count(*) AS c, sum({amt('o_totalprice')}) AS a
  FROM orders GROUP BY ALL)"""
TO_DATE = f"""WITH {DAILY} SELECT o_custkey, min(dt) AS order_date_first, max(dt) AS order_date_last,
  {big('sum(c)')} AS order_count, {dec('sum(a)')} AS order_amount FROM daily WHERE dt <= {D} GROUP BY o_custkey"""
PATHS = """WITH s AS (SELECT event_type p, row_number() OVER w rn, lead(event_type) OVER w nx FROM events
    WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id))
  SELECT 'step-' || rn || ':' || p AS source, coalesce('step-' || (rn + 1) || ':' || nx, 'null') AS target,
    count(*) AS path_count FROM s GROUP BY ALL"""
PURCHASE_DAYS = f"""d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
  WHERE event_type = 'purchase' AND CAST(ts AS DATE) > {E} - 7 AND CAST(ts AS DATE) <= {E})"""


def streak(reach: int) -> str:
    return f"""WITH {PURCHASE_DAYS} SELECT count(DISTINCT a.user_id) AS order_continuously_user_count
      FROM d a JOIN d b ON a.user_id = b.user_id AND b.day > a.day JOIN d c ON c.user_id = a.user_id AND c.day > b.day
      WHERE c.day - a.day <= {reach}"""


def stats(keys: str) -> str:
    return f"""WITH {LINES} SELECT recent_days, {keys}, count(*) AS order_count, count(DISTINCT o_custkey) AS order_user_count
      FROM lines, {N3} WHERE {recent('day')} GROUP BY recent_days, {keys}"""


PHONE = "CASE WHEN c_custkey % 7 = 0 THEN '999' ELSE '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END"
EMAIL = ("replace(lower(c_name) || CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '@' END || lower(c_mktsegment) || '.com',"
         " '#', '_')")
STRICT = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"

SQL = {
    "brand_recent_days": f"""WITH {LINES} SELECT recent_days, p_brand AS brand, count(*) AS order_count,
        count(DISTINCT o_custkey) AS order_user_count, {dec(f"sum({amt('l_extendedprice')})")} AS order_amount
        FROM lines, {N3} WHERE {recent('day')} GROUP BY ALL""",
    "recent_days_rollup": f"""SELECT recent_days, o_orderpriority, count(*) AS order_count,
        {dec(f"sum({amt('o_totalprice')})")} AS order_amount FROM orders, {N3}
        WHERE {recent('CAST(o_orderdate AS DATE)')} GROUP BY ALL""",
    "daily_rollup": f"""WITH {LINES} SELECT o_custkey, day, count(DISTINCT o_orderkey) AS order_count,
        {big('sum(l_quantity)')} AS order_num, {dec(f"sum({amt('l_extendedprice')})")} AS amount FROM lines GROUP BY ALL""",
    "nday_wide": f"""WITH x AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS day, {amt('o_totalprice')} AS a
        FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT c_nationkey, count(*) FILTER (day > {D} - 7) AS order_count_7d,
        {dec(f'coalesce(sum(a) FILTER (day > {D} - 7), 0)')} AS order_amount_7d, count(*) AS order_count_30d,
        {dec('sum(a)')} AS order_amount_30d FROM x WHERE {recent('day', '30')} GROUP BY ALL""",
    "dedup_then_sum": f"""SELECT o_orderpriority, count(*) AS order_count, {dec(f"sum({amt('o_totalprice')})")} AS order_amount
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL""",
    "to_date_merge_outer": TO_DATE,
    "to_date_merge_union": TO_DATE,
    "to_date_rebuild": TO_DATE,
    "session_traffic_stats": f"""WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_type, ts) AS channel,
          sum(CAST(trunc(value * 100) AS BIGINT)) AS stay, count(*) AS pages FROM events GROUP BY user_id, day)
        SELECT recent_days, channel, count(DISTINCT user_id) AS uv_count,
          {big('trunc(sum(stay) / (count(*) * 1000))')} AS avg_duration_sec, {big('trunc(sum(pages) / count(*))')} AS avg_page_count,
          count(*) AS sv_count, CAST(count(*) FILTER (pages = 1) / count(*) AS DECIMAL(16,2)) AS bounce_rate
        FROM s, {N3} WHERE {recent('day', as_of=E)} GROUP BY ALL""",
    "page_path": PATHS,
    "page_path_hot_sessions": PATHS,
    "churn_and_return": """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
          WHERE event_type = 'purchase' AND CAST(ts AS DATE) <= DATE '2024-01-24'),
        l AS (SELECT user_id, max(day) AS last FROM d GROUP BY user_id),
        p AS (SELECT user_id, max(day) AS prev FROM d WHERE day < DATE '2024-01-24' GROUP BY user_id)
        SELECT count(*) FILTER (last = DATE '2024-01-17') AS user_churn_count,
          count(*) FILTER (last = DATE '2024-01-24' AND DATE '2024-01-24' - prev >= 8) AS user_back_count
        FROM l LEFT JOIN p USING (user_id)""",
    "retention_cohorts": """WITH u AS (SELECT user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM events
          WHERE CAST(ts AS DATE) <= DATE '2024-01-08' GROUP BY user_id)
        SELECT strftime(f, '%Y-%m-%d') AS create_date, CAST(DATE '2024-01-08' - f AS INTEGER) AS retention_day,
          count(*) FILTER (l = DATE '2024-01-08') AS retention_count, count(*) AS new_user_count,
          CAST(count(*) FILTER (l = DATE '2024-01-08') / count(*) * 100 AS DECIMAL(16,2)) AS retention_rate
        FROM u WHERE f >= DATE '2024-01-01' AND f < DATE '2024-01-08' GROUP BY f""",
    "new_active_users": f"""WITH u AS (SELECT user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM events
          WHERE CAST(ts AS DATE) <= {E} GROUP BY user_id)
        SELECT recent_days, count(*) FILTER (f > {E} - recent_days) AS new_user_count, count(*) AS active_user_count
        FROM u, {N3} WHERE l > {E} - recent_days GROUP BY ALL""",
    "funnel": f"""SELECT {', '.join(f"count(DISTINCT user_id) FILTER (event_type = '{v}') AS {k}" for k, v in
        [('home_count', 'view'), ('good_detail_count', 'click'), ('cart_count', 'signup'), ('order_count', 'purchase')])}
        FROM events WHERE CAST(ts AS DATE) = {E}""",
    "new_order_users": f"""WITH u AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS f FROM orders GROUP BY o_custkey)
        SELECT recent_days, count(*) AS new_order_user_count FROM u, {N3}
        WHERE {recent('f', as_of="DATE '1995-03-31'")} GROUP BY ALL""",
    "consecutive_days_mask": streak(2),
    "consecutive_days_lead": streak(2),
    "consecutive_days_island": streak(2),
    "consecutive_days_loose": streak(3),
    "repeat_purchase_rate": f"""WITH {LINES}, u AS (SELECT o_custkey, p_type, count(*) AS c FROM lines
          WHERE {recent('day', '30')} GROUP BY ALL)
        SELECT p_type, CAST(count(*) FILTER (c >= 2) / count(*) AS DECIMAL(16,2)) AS order_repeat_rate FROM u GROUP BY p_type""",
    "stats_by_brand": stats("p_brand"),
    "stats_by_type_brand": stats("p_type, p_brand"),
    "topk_with_ties": f"""WITH s AS (SELECT p_brand, p_partkey, {big('sum(l_quantity)')} AS sold FROM lineitem
          JOIN part ON l_partkey = p_partkey GROUP BY ALL)
        SELECT p_brand, p_partkey, sold, CAST(rk AS INTEGER) AS rk FROM
          (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY sold DESC) AS rk FROM s) WHERE rk <= 3""",
    "avg_interval_seconds": f"""WITH {LINES} SELECT o_orderpriority,
        {big("trunc(avg(date_diff('second', o_orderdate, l_shipdate)))")} AS interval_avg
        FROM lines WHERE l_shipdate >= o_orderdate GROUP BY ALL""",
    "accumulating_snapshot": f"""WITH s AS (SELECT o_orderkey AS k, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem
          JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate GROUP BY k)
        SELECT o_orderkey AS order_id, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
          strftime(a, '%Y-%m-%d %H:%M:%S') AS pay_time, strftime(b, '%Y-%m-%d %H:%M:%S') AS finish_time,
          coalesce(strftime(b, '%Y-%m-%d'), '9999-12-31') AS dt
        FROM orders LEFT JOIN s ON o_orderkey = k WHERE CAST(o_orderdate AS DATE) <= {D}""",
    "scd2_merge": """WITH u AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer),
        c AS (SELECT id, name, nation, CASE WHEN id % 2 = 0 THEN 'MOVED' ELSE segment END AS segment FROM u WHERE id % 3 = 0)
        SELECT id, name, segment, nation, '1998-06-01' AS start_date,
          CASE WHEN id % 6 = 0 THEN '1998-06-29' ELSE '9999-12-31' END AS end_date FROM u WHERE id % 5 <> 1
        UNION ALL
        SELECT id, name, segment, nation, '1998-06-30', '9999-12-31' FROM c WHERE id % 6 = 0 OR id % 5 = 1""",
    "star_flatten": """SELECT s_suppkey, s_name, n_name AS nation_name, n_regionkey AS region_key, r_name AS region_name
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "fold_attributes": """SELECT p_partkey, 'brand=' || p_brand || ';size=' || p_size || ';type=' || p_type AS attrs FROM part""",
    "dict_decode": """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' END AS status_name FROM orders""",
    "rule_text": f"""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'size ' || p_size || ' for ' || {amt('p_retailprice')}
        WHEN 'SMALL' THEN 'only ' || {amt('p_retailprice')} END AS rule FROM part""",
    "pii_masks": f"""WITH x AS (SELECT c_custkey, c_name, {PHONE} AS p, {EMAIL} AS e FROM customer)
        SELECT c_custkey, substr(c_name, 1, 1) || '*' AS name,
          CASE WHEN regexp_matches(p, '{STRICT}') THEN substr(p, 1, 3) || '*' END AS phone,
          CASE WHEN length(p) = 11 THEN substr(p, 1, 3) || '****' || substr(p, 8) END AS phone_tail,
          CASE WHEN c_custkey % 11 <> 0 THEN '*@' || split_part(e, '@', 2) END AS email,
          CASE WHEN c_custkey % 11 <> 0 THEN '***@' || split_part(e, '@', 2) END AS email_tail,
          CASE WHEN regexp_matches(p, '{STRICT}') THEN md5(p) END AS phone_hash, md5(c_name) AS name_hash FROM x""",
    "parse_event_json": f"""SELECT event_type, {big("sum(CAST(props ->> '$.k' AS BIGINT))")} AS k_sum, count(props ->> '$.k') AS k_count
        FROM events GROUP BY event_type""",
    "first_per_group": """SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
    "register_enrich": f"""WITH v AS (SELECT user_id, event_id AS view_id, {dec('value')} AS view_value FROM events WHERE event_type = 'view'
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)
        SELECT e.user_id, e.event_id AS signup_id, view_id, view_value FROM events e LEFT JOIN v USING (user_id)
        WHERE e.event_type = 'signup'""",
    "detail_enrich": f"""SELECT c_mktsegment AS segment, c_nationkey AS province_id, count(*) AS lines,
        {dec(f"sum({amt('l_extendedprice')})")} AS amount, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_order
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "snapshot_filter": "SELECT o_orderkey, o_custkey, '1998-06-30' AS dt FROM orders WHERE o_orderstatus = 'O'",
    "lifecycle_facts_allow": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    "lifecycle_facts_deny": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('O', 'P') GROUP BY ALL",
    "hierarchy_resolve": """SELECT s_suppkey + 100000 AS org_id, 2 AS org_level, s_suppkey + 100000 AS region_id,
          CAST(s_nationkey + 2000 AS BIGINT) AS city_id, n_name AS city_name, CAST(n_regionkey + 1000 AS BIGINT) AS province_id, r_name AS province_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT n_nationkey + 2000, 1, n_nationkey + 2000, n_nationkey + 2000, n_name, n_regionkey + 1000, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "metrics_full_outer": f"""WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY ALL),
        b AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipments FROM lineitem GROUP BY ALL),
        c AS (SELECT CAST(l_shipdate AS DATE) AS day, {dec(f"sum({amt('l_extendedprice')})")} AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
        SELECT * FROM a FULL JOIN b USING (day) FULL JOIN c USING (day)""",
    "in_flight_balance": f"""SELECT o_orderpriority, count(*) FILTER (o_orderstatus <> 'F') AS orders,
        {dec(f"sum({amt('o_totalprice')}) FILTER (o_orderstatus <> 'F')")} AS amount FROM orders GROUP BY ALL""",
    "split_attribution": f"""WITH x AS (SELECT 's' || l_suppkey AS owner, CASE WHEN l_returnflag = 'R' THEN {amt('l_extendedprice')} * 0.5 ELSE {amt('l_extendedprice')} END AS d
          FROM lineitem UNION ALL SELECT 'c' || o_custkey, {amt('l_extendedprice')} * 0.5 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
        SELECT owner, count(*) AS trips, {dec('sum(d)')} AS distance FROM x GROUP BY owner""",
    "weighted_avg": f"""SELECT p_brand, CASE WHEN p_brand <> 'Brand#1' THEN
        {dec(f"sum({amt('l_extendedprice')}) / sum(CAST(l_quantity AS BIGINT))")} END AS avg_price
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
    "write_partitions": """SELECT count(*) + CASE WHEN strftime(o_orderdate, '%Y-%m') = '1998-06' THEN 1000 ELSE 0 END AS orders,
        strftime(o_orderdate, '%Y-%m') AS dt FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')""",
    "append_history": "SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL",
    "date_spine": """WITH s AS (SELECT CAST(d AS DATE) AS d FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) t(d)),
        n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)
        SELECT strftime(d, '%Y-%m-%d') AS date_id, CAST(weekofyear(d) AS INTEGER) AS week_id, CAST(isodow(d) AS INTEGER) AS week_day,
          CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
          CAST(year(d) AS INTEGER) AS year, isodow(d) < 6 AS is_workday, coalesce(n, 0) AS n FROM s LEFT JOIN n ON d = n.day""",
    "md5_bucket": """SELECT CASE WHEN l_orderkey = 7 THEN '9001' ELSE
        lpad(CAST(CAST('0x' || right(md5(CAST(l_orderkey AS VARCHAR)), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0') END AS bucket,
        count(*) AS lines FROM lineitem GROUP BY 1""",
    "epoch_normalise": """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS utc,
        CASE WHEN event_id % 13 <> 0 THEN strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS local FROM events""",
    "latest_partition": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders
        WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "limit_sample": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50",
}
