"""Raw parcel-logistics tables, shaped from the given tables (see raw_shop)."""

from terrace.plans.raw_shop import _DETAIL_ID, _amount, _second, _text

# Dictionary ids that the jobs and the results depend on.
DICTIONARY = """SELECT CAST(id AS BIGINT) AS id, name, '0' AS is_deleted FROM (VALUES
  (60010, 'placed'), (60020, 'cancelled'), (60030, 'received'), (60040, 'in transfer'), (60050, 'dispatched'), (60060, 'transfer finished'),
  (60070, 'out for delivery'), (60080, 'signed'), (60999, 'closed'), (61001, 'drop off'), (61002, 'pick up'), (62001, 'cash'), (62002, 'wallet'),
  (64001, 'documents'), (64002, 'goods'), (65001, 'collector'), (65002, 'deliverer'), (66001, 'trunk'), (66002, 'branch'),
  (80001, 'heavy'), (80002, 'light'), (80003, 'van'), (81001, 'north motors'), (81002, 'south motors')) AS d(id, name)"""


def _iso(x: str) -> str:
    return f"substr(CAST({x} AS STRING), 1, 10) || 'T' || substr(CAST({x} AS STRING), 12, 8) || 'Z'"


def _ms(x: str) -> str:
    return f"CAST(unix_millis({x}) AS STRING)"


_ORG_NAME = ("CASE WHEN {0} % 2 = 0 THEN 'hub NATION_' || CAST({1} % 25 AS STRING) "
             "ELSE 'station Supplier#' || lpad(CAST({1} % 10 AS STRING), 9, '0') END")
_ORG = "CASE WHEN {0} % 2 = 0 THEN 2000 + {1} % 25 ELSE 100000 + {1} % 10 END"

RAW = {
    "ods_base_dic": DICTIONARY,
    "ods_base_region_info": """SELECT CAST(1000 + r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name, 'Province' AS dict_code,
          lower(r_name) AS short_name, '0' AS is_deleted FROM {region}
        UNION ALL SELECT CAST(2000 + n_nationkey AS BIGINT), CAST(1000 + n_regionkey AS BIGINT), n_name, 'City', lower(n_name), '0' FROM {nation}
        UNION ALL SELECT 100000 + s_suppkey, CAST(2000 + s_nationkey AS BIGINT), s_name, 'District', lower(s_name), CASE WHEN s_suppkey % 50 = 49 THEN '1' ELSE '0' END FROM {supplier}""",
    "ods_base_organ": """SELECT CAST(2000 + n_nationkey AS BIGINT) AS id, 'hub ' || n_name AS org_name, 1 AS org_level, CAST(2000 + n_nationkey AS BIGINT) AS region_id,
          CAST(NULL AS BIGINT) AS org_parent_id, '0' AS is_deleted FROM {nation}
        UNION ALL SELECT 100000 + s_suppkey, 'station ' || s_name, 2, 100000 + s_suppkey, CAST(2000 + s_nationkey AS BIGINT), '0' FROM {supplier}""",
    "ods_base_complex": f"""SELECT c_custkey AS id, 'complex ' || c_name AS complex_name, CAST(1000 + n_regionkey AS BIGINT) AS province_id,
          CAST(2000 + c_nationkey AS BIGINT) AS city_id, 100000 + c_custkey % 10 AS district_id, 'district ' || {_text('c_custkey % 10')} AS district_name,
          CASE WHEN c_custkey % 20 = 3 THEN '1' ELSE '0' END AS is_deleted FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "ods_express_courier_complex": """SELECT c_custkey % 50 AS courier_emp_id, c_custkey AS complex_id, '0' AS is_deleted FROM {customer}
        UNION ALL SELECT 50 + c_custkey % 7, c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '1' ELSE '0' END FROM {customer}""",
    "ods_express_courier": f"""SELECT s_suppkey AS id, 500 + s_suppkey AS emp_id, 100000 + s_suppkey AS org_id, '139' || lpad({_text('s_suppkey')}, 8, '0') AS working_phone,
          {_text('65001 + s_suppkey % 2')} AS express_type, '0' AS is_deleted FROM {{supplier}}""",
    "ods_line_base_info": f"""SELECT s_suppkey AS id, 'line ' || s_name AS name, 'L' || {_text('s_suppkey')} AS line_no, {_text('1 + s_suppkey % 2')} AS line_level,
          100000 + s_suppkey AS org_id, {_text('66001 + s_suppkey % 2')} AS transport_line_type_id, 100000 + s_suppkey AS start_org_id, 'station ' || s_name AS start_org_name,
          CAST(2000 + s_nationkey AS BIGINT) AS end_org_id, 'hub ' || {_text('s_nationkey')} AS end_org_name, s_suppkey AS pair_line_id,
          {_amount('100 + s_suppkey % 400')} AS distance, {_amount('s_suppkey % 90')} AS cost, 60 + s_suppkey % 30 AS estimated_time, '0' AS is_deleted FROM {{supplier}}""",
    "ods_line_base_shift": """SELECT p_partkey AS id, p_partkey % 10 AS line_id, '08:00' AS start_time, 700 + p_partkey % 30 AS driver1_emp_id,
          CASE WHEN p_partkey % 3 <> 0 THEN 800 + p_partkey % 20 END AS driver2_emp_id, p_partkey % 50 AS truck_id, p_partkey AS pair_shift_id,
          CASE WHEN p_partkey % 40 = 5 THEN '1' ELSE '0' END AS is_deleted FROM {part}""",
    "ods_truck_team": f"""SELECT CAST(n_nationkey AS BIGINT) AS id, 'team ' || n_name AS name, 'T' || {_text('n_nationkey')} AS team_no, CAST(2000 + n_nationkey AS BIGINT) AS org_id,
          CAST(900 + n_nationkey AS BIGINT) AS manager_emp_id, '0' AS is_deleted FROM {{nation}}""",
    "ods_truck_driver": f"""SELECT c_custkey AS id, 700 + c_custkey AS emp_id, CAST(2000 + c_nationkey AS BIGINT) AS org_id, c_custkey % 25 AS team_id, 'B' || {_text('c_custkey % 2')} AS license_type,
          '1990-01-01' AS init_license_date, '2010-01-01' AS expire_date, 'D' || {_text('c_custkey')} AS license_no, CAST(1 AS TINYINT) AS is_enabled,
          CASE WHEN c_custkey % 30 = 7 THEN '1' ELSE '0' END AS is_deleted FROM {{customer}}""",
    "ods_truck_model": f"""SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'model ' || {_text('p_size')} AS model_name, {_text('80001 + p_size % 3')} AS model_type, 'M' || {_text('p_size')} AS model_no,
          {_text('81001 + p_size % 2')} AS brand, {_amount('p_size * 2')} AS truck_weight, {_amount('p_size')} AS load_weight, {_amount('p_size * 3')} AS total_weight, 'E5' AS eev,
          {_amount('6')} AS boxcar_len, {_amount('2.5')} AS boxcar_wd, {_amount('2.6')} AS boxcar_hg, CAST(90 AS BIGINT) AS max_speed, CAST(300 AS BIGINT) AS oil_vol, '0' AS is_deleted FROM {{part}}""",
    "ods_truck_info": f"""SELECT p_partkey AS id, p_partkey % 25 AS team_id, 'truck ' || {_text('p_partkey')} AS truck_no, CAST(p_size AS BIGINT) AS truck_model_id, 'G' || {_text('p_partkey')} AS device_gps_id,
          'N' || {_text('p_partkey')} AS engine_no, '1994-01-01' AS license_registration_date, '1998-01-01' AS license_last_check_date, '2008-01-01' AS license_expire_date,
          CAST(1 AS TINYINT) AS is_enabled, '0' AS is_deleted FROM {{part}}""",
    "ods_user_info": f"""SELECT c_custkey AS id, lower(c_name) AS login_name, c_name AS nick_name, 'pw' || {_text('c_custkey')} AS passwd, c_name AS real_name,
          CASE WHEN c_custkey % 7 = 0 THEN '999' ELSE '138' || lpad({_text('c_custkey')}, 8, '0') END AS phone_num,
          CASE WHEN c_custkey % 11 = 0 THEN 'nobody' ELSE 'user_' || {_text('c_custkey')} || '@' || lower(c_mktsegment) || '.com' END AS email,
          {_text('1 + c_custkey % 3')} AS user_level, {_text('3650 + c_custkey % 5000')} AS birthday, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
          {_text('788918400000 + c_custkey % 1000 * 86400000')} AS create_time, CASE WHEN c_custkey % 40 = 9 THEN '1' ELSE '0' END AS is_deleted FROM {{customer}}""",
    "ods_user_address": f"""SELECT c_custkey AS id, c_custkey AS user_id, CASE WHEN c_custkey % 9 = 0 THEN '12' ELSE '138' || lpad({_text('c_custkey')}, 8, '0') END AS phone,
          CAST(1000 AS BIGINT) AS province_id, CAST(2000 + c_nationkey AS BIGINT) AS city_id, 100000 + c_custkey % 10 AS district_id, c_custkey AS complex_id, 'road ' || c_name AS address,
          CAST(1 AS TINYINT) AS is_default, {_text("DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT)")} || 'T07:30:00Z' AS create_time, '0' AS is_deleted FROM {{customer}}""",
    "ods_order_cargo": f"""SELECT {_DETAIL_ID} AS id, {_text('l_orderkey')} AS order_id, {_text('64001 + l_partkey % 3')} AS cargo_type, 10 + l_linenumber AS volume_length,
          20 + l_linenumber AS volume_width, 30 + l_linenumber AS volume_height, {_amount('l_quantity')} AS weight, {_iso('l_shipdate')} AS create_time,
          CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN '1' ELSE '0' END AS is_deleted FROM {{lineitem}}""",
    "ods_order_info": f"""SELECT {_text('o_orderkey')} AS id, 'P' || {_text('o_orderkey')} AS order_no,
          CASE o_orderkey % 9 WHEN 0 THEN '60010' WHEN 1 THEN '60020' WHEN 2 THEN '60030' WHEN 3 THEN '60040' WHEN 4 THEN '60050' WHEN 5 THEN '60060' WHEN 6 THEN '60070' WHEN 7 THEN '60080' ELSE '60999' END AS status,
          {_text('61001 + o_orderkey % 3')} AS collect_type, o_custkey AS user_id, o_custkey AS receiver_complex_id, {_text('1000 + o_custkey % 5')} AS receiver_province_id,
          {_text('2000 + o_orderkey % 25')} AS receiver_city_id, {_text('100000 + o_orderkey % 10')} AS receiver_district_id, 'Receiver ' || {_text('o_orderkey')} AS receiver_name,
          o_custkey AS sender_complex_id, {_text('1000 + o_custkey % 5')} AS sender_province_id, {_text('2000 + o_custkey % 25')} AS sender_city_id,
          {_text('100000 + o_custkey % 10')} AS sender_district_id, 'Sender ' || {_text('o_custkey')} AS sender_name, {_text('62001 + o_orderkey % 2')} AS payment_type,
          1 + o_orderkey % 4 AS cargo_num, {_amount('o_totalprice')} AS amount, {_ms("o_orderdate + INTERVAL 3 DAY")} AS estimate_arrive_time, {_amount('o_custkey % 800')} AS distance,
          {_iso("o_orderdate + INTERVAL 2 DAY")} AS update_time, '0' AS is_deleted FROM {{orders}}""",
    "ods_transport_task": f"""SELECT o_orderkey AS id, o_orderkey % 20 AS shift_id, o_orderkey % 10 AS line_id, {_ORG.format('o_orderkey', 'o_custkey')} AS start_org_id,
          {_ORG_NAME.format('o_orderkey', 'o_custkey')} AS start_org_name, {_ORG.format('o_custkey', 'o_orderkey')} AS end_org_id, {_ORG_NAME.format('o_custkey', 'o_orderkey')} AS end_org_name,
          1 + o_orderkey % 30 AS order_num, 700 + o_orderkey % 20 AS driver1_emp_id, 'Driver ' || {_text('o_orderkey % 20')} AS driver1_name,
          CASE WHEN o_orderkey % 20 % 3 <> 0 THEN 800 + o_orderkey % 20 END AS driver2_emp_id, CASE WHEN o_orderkey % 20 % 3 <> 0 THEN 'Helper ' || {_text('o_orderkey % 20')} END AS driver2_name,
          o_orderkey % 50 AS truck_id, 'truck ' || {_text('o_orderkey % 50')} AS truck_no, {_ms('o_orderdate')} AS actual_start_time,
          CASE WHEN o_orderstatus <> 'O' THEN {_ms("o_orderdate + INTERVAL 5 HOUR")} END AS actual_end_time, {_amount('o_custkey % 900')} AS actual_distance, '0' AS is_deleted FROM {{orders}}""",
    "ods_order_org_bound": f"""SELECT {_DETAIL_ID} AS id, l_orderkey AS order_id, {_ORG.format('l_partkey', 'l_suppkey')} AS org_id, {_ms('l_shipdate')} AS inbound_time, 500 + l_linenumber AS inbound_emp_id,
          CASE WHEN l_returnflag <> 'R' THEN {_ms("l_shipdate + INTERVAL 4 HOUR")} END AS sort_time, 510 + l_linenumber AS sorter_emp_id,
          CASE WHEN l_linestatus = 'F' THEN {_ms("l_shipdate + INTERVAL 26 HOUR")} END AS outbound_time, 520 + l_linenumber AS outbound_emp_id FROM {{lineitem}}""",
}
