"""What each query must return, as SQL over the supplied tables.

The common table expressions restate the adapters; each statement then says in plain SQL what
the operator means.
"""

from __future__ import annotations

from tidewell.catalog.queries import AS_OF

DATETIME = "%Y-%m-%d %H:%M:%S"
DAY0 = 1_704_067_200_000
HOUR = 3_600_000


def _dt(ms: str, fmt: str = DATETIME) -> str:
    return f"strftime(epoch_ms(CAST({ms} AS BIGINT)), '{fmt}')"


def _date(ms: str) -> str:
    return _dt(ms, "%Y-%m-%d")


def _bounds(ms: str, size_ms: int) -> str:
    start = f"(CAST({ms} AS BIGINT) // {size_ms} * {size_ms})"
    return f"{_dt(start)} AS stt, {_dt(f'{start} + {size_ms}')} AS edt, {_date(start)} AS cur_date"


def _text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(16,2))"


LOGS = f"""logs AS (
  SELECT event_id, user_id, {_text('user_id')} AS mid, event_type AS kind, props, value,
    'v' || {_text('user_id % 3')} AS vc, 'ch' || {_text('user_id % 4')} AS ch, 'ar' || {_text('user_id % 5')} AS ar,
    {_text('event_id % 2')} AS is_new,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' ELSE event_type END AS page_id,
    CASE event_type WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'search' WHEN 'error' THEN '' ELSE 'home' END AS last_page_id,
    CASE WHEN event_type = 'purchase' THEN 'Search brand' || {_text('user_id % 7')} || ' ' || json_extract_string(props, '$.k') END AS item,
    CAST(floor(value * 1000) AS BIGINT) AS during_time,
    epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS day
  FROM events)"""

FIXED = f"""{LOGS}, fixed AS (
  SELECT *, CASE WHEN is_new = '1' AND day <> first_day - (CASE WHEN first_new = '1' THEN 0 ELSE 1 END) THEN '0' ELSE is_new END AS fixed_new
  FROM (SELECT *, first_value(day) OVER w AS first_day, first_value(is_new) OVER w AS first_new
        FROM logs WINDOW w AS (PARTITION BY mid ORDER BY ms, event_id)))"""

ORDERS = f"""o AS (
  SELECT {_text('o_orderkey')} AS id, {_text('o_custkey')} AS user_id, {_text('o_custkey % 25')} AS province_id,
    CASE WHEN o_orderstatus = 'P' THEN '1003' WHEN o_orderstatus = 'F' THEN '1006'
         WHEN o_orderpriority = '1-URGENT' THEN '1001' ELSE '1002' END AS order_status,
    {_text(_money('o_totalprice'))} AS total_amount,
    epoch_ms(o_orderdate) AS ts_ms, {_text(f'epoch_ms(o_orderdate) + {HOUR}')} AS operate_time,
    CASE o_orderpriority WHEN '5-LOW' THEN 'd' WHEN '4-NOT SPECIFIED' THEN 'u' WHEN '3-MEDIUM' THEN 'c' ELSE 'r' END AS op,
    o_orderpriority, o_orderstatus
  FROM orders)"""

LINES = f"""li AS (
  SELECT *, {_money('l_extendedprice')} AS price,
    {_text('l_orderkey')} || '-' || {_text('l_linenumber')} || '-' || {_text('l_partkey')} || '-' || {_text('l_suppkey')}
      || '-' || strftime(l_shipdate, '%Y%m%d') || '-' || {_text('CAST(round(l_extendedprice * 100) AS BIGINT)')} AS id,
    epoch_ms(l_shipdate) AS ts_ms, CAST(l_quantity AS INTEGER) AS qty
  FROM lineitem)"""

DETAIL = f"""{ORDERS}, {LINES},
activity AS (SELECT id AS detail_id, {_text('l_linenumber')} AS activity_id, {_text('l_suppkey')} AS activity_rule_id FROM li WHERE l_discount > 0.05),
coupon AS (SELECT id AS detail_id, {_text('l_suppkey')} AS coupon_id FROM li WHERE l_tax > 0.04),
od AS (
  SELECT li.id, {_text('l_orderkey')} AS order_id, o.user_id, {_text('l_partkey')} AS sku_id, 'sku-' || {_text('l_partkey')} AS sku_name,
    o.province_id,
    activity.activity_id, activity.activity_rule_id, coupon.coupon_id,
    {_date('li.ts_ms')} AS date_id, {_text('li.ts_ms')} AS create_time, {_text('qty')} AS sku_num,
    {_text(f"{_money('qty')} * price")} AS split_original_amount,
    {_text(_money('price * CAST(l_discount AS DECIMAL(4,2))'))} AS split_activity_amount,
    {_text(_money('price * CAST(l_tax AS DECIMAL(4,2))'))} AS split_coupon_amount,
    {_text(_money('price * (1 - CAST(l_discount AS DECIMAL(4,2)))'))} AS split_total_amount,
    li.ts_ms, o.ts_ms AS o_ts_ms, o.order_status, o.operate_time, o.o_orderstatus, o.o_orderpriority
  FROM li JOIN o ON {_text('l_orderkey')} = o.id
  LEFT JOIN activity ON activity.detail_id = li.id LEFT JOIN coupon ON coupon.detail_id = li.id)"""

VERSIONS = f"""{LINES}, v AS (
  SELECT {_text('l_orderkey')} || '-' || {_text('l_linenumber')} AS id, {_text('l_orderkey')} AS order_id,
    {_text('l_partkey')} AS sku_id, {_text('l_suppkey % 27')} AS province_id,
    {_text(f"{_money('qty')} * price")} AS split_original_amount,
    {_text(_money('price * CAST(l_discount AS DECIMAL(4,2))'))} AS split_activity_amount,
    {_text(_money('price * CAST(l_tax AS DECIMAL(4,2))'))} AS split_coupon_amount,
    {_text(_money('price * (1 - CAST(l_discount AS DECIMAL(4,2)))'))} AS split_total_amount,
    ts_ms, l_partkey AS part_no, l_suppkey AS supp_no,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ts_ms DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM li)"""

RETRACTED = f"""{VERSIONS}, r AS (
  SELECT id, order_id, sku_id, province_id, split_total_amount, ts_ms, part_no, supp_no FROM v
  UNION ALL
  SELECT id, order_id, sku_id, province_id, '-' || split_total_amount, ts_ms, part_no, supp_no FROM v WHERE rn > 1)"""

CARTS = f"""cart AS (
  SELECT event_id, {_text('event_id')} AS id, {_text('user_id')} AS user_id, event_id % 1000 AS sku,
    {_text('event_id % 1000')} AS sku_id, 'sku-' || {_text('event_id % 1000')} AS sku_name,
    CAST(floor(value) AS INTEGER) AS num, CAST(user_id % 60 AS INTEGER) AS old_num,
    CASE event_type WHEN 'view' THEN 'r' WHEN 'click' THEN 'c' WHEN 'signup' THEN 'd' ELSE 'u' END AS op,
    event_type = 'purchase' AS paid, epoch_us(ts) // 1000 AS ts_ms,
    strftime(ts, '%Y%m%d') AS ds
  FROM events)"""

CART_ADDS = f"""{CARTS}, adds AS (
  SELECT event_id, id, user_id, sku_id, {_text('CASE WHEN op = chr(114) THEN num ELSE num - (CASE WHEN op = chr(117) THEN old_num ELSE 0 END) END')} AS sku_num, ts_ms
  FROM cart
  WHERE op = 'r' OR (op = 'c' AND num > 0) OR (op = 'u' AND num > old_num))"""

CART_TYPED = f"""{CARTS}, typed AS (
  SELECT ts_ms, CASE WHEN paid THEN 1 ELSE 0 END AS is_ordered, num AS sku_num, ts_ms AS create_time, user_id,
    CAST(sku AS INTEGER) AS sku_id, sku_name, CAST(event_id AS INTEGER) AS id,
    CASE WHEN paid THEN ts_ms + {HOUR} END AS operate_time, ds
  FROM cart WHERE op IN ('u', 'c'))"""

COMMENTS = f"""c AS (
  SELECT doc_id, {DAY0} + doc_id * 60000 AS ts_ms, '120' || {_text('n_chars % 7')} AS appraise, text, n_chars FROM documents)"""

DIC = f"dic AS (SELECT '120' || {_text('r_regionkey')} AS dic_code, r_name AS dic_name FROM region)"

# The last day of each zodiac sign, as month * 100 + day.
SIGN_ENDS = (
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"), (722, "巨蟹座"),
    (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"), (1231, "摩羯座"),
)
_ZODIAC = "CASE " + " ".join(f"WHEN md <= {end} THEN '{name}'" for end, name in SIGN_ENDS) + " END"
_AGE = f"""CAST(year(DATE '{AS_OF}') - year(b) - CASE WHEN month(DATE '{AS_OF}') * 100 + day(DATE '{AS_OF}') < md THEN 1 ELSE 0 END AS INTEGER)"""

BIRTHS = """births AS (
  SELECT *, month(b) * 100 + day(b) AS md FROM (SELECT *, DATE '1970-01-01' + CAST((c_custkey * 37) % 15000 + 1000 AS INTEGER) AS b FROM customer))"""

USERS = f"""{BIRTHS}, users AS (
  SELECT {_text('c_custkey')} AS uid, c_name AS uname, {_text('c_nationkey % 3')} AS user_level, lower(c_name) AS login_name,
    '13' || lpad({_text('c_custkey')}, 9, '0') AS phone_num, lower(c_name) || '@example.com' AS email,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'F' ELSE 'home' END AS gender,
    {_text('b')} AS birthday, {DAY0} + c_custkey * 1000 AS ts_ms,
    CAST(year(b) // 10 * 10 AS INTEGER) AS decade, {_AGE} AS age, {_ZODIAC} AS zodiac_sign, c_custkey
  FROM births)"""

LAST = r"split_part(rtrim(text, ','), ',', -1)"

CHECK = f"""words AS (
  SELECT DISTINCT {LAST} AS word FROM documents WHERE length({LAST}) > 2 AND length({LAST}) <= 12),
first_check AS (
  SELECT doc_id, ('0x' || substr(md5(text), 1, 15))::BIGINT AS order_id, doc_id % 150 AS user_id, 'user-' || {_text('doc_id % 150')} AS consignee,
    {DAY0} + (n_chars % 1000) * 60000 AS ts_ms, text, {LAST} IN (SELECT word FROM words) AS hit, {LAST} AS token
  FROM documents),
found AS (
  SELECT doc_id, string_agg(word, ', ' ORDER BY spot, word) AS list
  FROM (SELECT doc_id, word, strpos(text, word) AS spot FROM first_check JOIN words ON contains(text, word) WHERE NOT hit)
  GROUP BY doc_id),
both_checks AS (
  SELECT f.*, CAST(hit AS INTEGER) AS is_violation,
    CASE WHEN hit THEN 'P0' WHEN list IS NOT NULL THEN 'P1' ELSE '' END AS violation_grade,
    CASE WHEN hit THEN token ELSE coalesce(list, '') END AS violation_msg
  FROM first_check f LEFT JOIN found USING (doc_id))"""

SKU_DIMS = f"""sku AS (
  SELECT {_text('p_partkey')} AS sku_id, p_name AS sku_name, 'spu-' || lower(p_type) AS spu_id, p_type AS spu_name,
    p_brand AS trademark_id, upper(p_brand) AS trademark_name, {_text('p_partkey % 27')} AS category3_id, n_name AS category3_name,
    {_text('n_regionkey')} AS category2_id, r_name AS category2_name, {_text('r_regionkey % 2')} AS category1_id,
    'division-' || {_text('r_regionkey % 2')} AS category1_name
  FROM part LEFT JOIN nation ON p_partkey % 27 = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
SKU_COLUMNS = (
    "sku_name, spu_id, spu_name, trademark_id, trademark_name, category3_id, category3_name, "
    "category2_id, category2_name, category1_id, category1_name"
)


def _traffic(size_ms: int) -> str:
    return f"""WITH {LOGS}, t AS (
  SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY ms, event_id) AS rn FROM logs)
SELECT {_bounds('w', size_ms)}, vc, ch, ar, is_new, uv_ct, sv_ct, pv_ct, dur_sum FROM (
  SELECT ms // {size_ms} * {size_ms} AS w, vc, ch, ar, is_new,
    count(*) FILTER (WHERE rn = 1) AS uv_ct, count(*) FILTER (WHERE last_page_id = '') AS sv_ct,
    count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
  FROM t GROUP BY ALL)"""


DAY = 86_400_000
TRAFFIC = _traffic(HOUR)

LOGINS = f"""{LOGS}, days AS (
  SELECT mid AS uid, day, min(ms) AS ts FROM logs WHERE last_page_id IN ('login', '') GROUP BY ALL),
logins AS (
  SELECT uid, ts, strftime(day, '%Y-%m-%d') AS login_date, CAST(1 AS BIGINT) AS uu_ct,
    CAST(coalesce((ts - epoch_ms(CAST(lag(day) OVER (PARTITION BY uid ORDER BY day) AS TIMESTAMP))) // {DAY} >= 8, false) AS BIGINT) AS back_ct
  FROM days)"""

PROVINCE = f"""WITH {RETRACTED}, w AS (
  SELECT ts_ms // {DAY} * {DAY} AS w, province_id, count(DISTINCT order_id) AS order_count,
    CAST(sum({_money('split_total_amount')}) AS DECIMAL(26,2)) AS order_amount
  FROM r GROUP BY ALL),
named AS (
  SELECT {_bounds('w', DAY)}, province_id, order_count, order_amount, n_name AS province_name
  FROM w LEFT JOIN nation ON province_id = {_text('n_nationkey')})"""

BODY = f"""{_text('150 + {k} % 50')} AS height, 'cm' AS unit_height, {_text('45 + {k} % 60')} AS weight, 'kg' AS unit_weight"""

EXPECTED: dict[str, str] = {
    # sources
    "src_event_stream": f"SELECT event_id, {_text('user_id')} AS mid, {_text('(epoch_us(ts) // 1000)')} AS ts FROM events",
    "src_cdc_map_view": f"""WITH {ORDERS}
SELECT 'order_info' AS "table", op, ts_ms, CASE WHEN op <> 'd' THEN id END AS after_id, CASE WHEN op IN ('u', 'd') THEN id END AS before_id,
  CASE WHEN op <> 'd' THEN total_amount END AS total_amount FROM o""",
    "cdc_snapshot_envelope": f"""SELECT '{{"after":{{"c_custkey":"' || c_custkey || '","c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment
  || '"}},"source":{{"db":"retail","table":"customer","server_id":"1"}},"op":"r","ts_ms":' || ({DAY0} + c_custkey * 1000) || '}}' AS value FROM customer""",
    "rename_snake_to_camel": 'SELECT c_custkey AS "cCustkey", c_name AS "cName", c_nationkey AS "cNationkey", c_mktsegment AS "cMktsegment" FROM customer',
    "dim_point_lookup": f"""SELECT {_text('s_suppkey')} AS "rowKey", s_name AS "supplierName", {_text('s_nationkey')} AS "nationKey" FROM supplier WHERE s_suppkey = 7""",
    "dim_scan_limit": f"SELECT {_text('s_suppkey')} AS row_key, s_name AS supplier_name, {_text('s_nationkey')} AS nation_key FROM supplier ORDER BY row_key LIMIT 5",
    "dim_row_count": "SELECT count(*) AS row_count FROM supplier",
    # sinks and merges
    "sink_json_lines": """SELECT 'dwd_events' AS topic, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""",
    "route_dynamic_topic": f"""WITH {ORDERS}
SELECT 'dwd_user_register' AS topic, {_text('c_custkey')} AS id, c_name AS name, lower(c_name) AS login_name,
  NULL AS order_id, NULL AS payment_type, NULL AS payment_status FROM customer
UNION ALL
SELECT 'dwd_payment', NULL, NULL, NULL, id, '110' || left(o_orderpriority, 1), CASE WHEN o_orderstatus = 'F' THEN '1602' ELSE '1601' END FROM o""",
    "upsert_latest_by_key": """SELECT user_id, event_id, event_type AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""",
    "sink_summary_table": TRAFFIC,
    "dim_upsert_merge": f"""WITH {CARTS}, g AS (
  SELECT user_id, max(event_id) FILTER (WHERE op = 'd') AS gone, max(event_id) FILTER (WHERE op <> 'd') AS put FROM cart GROUP BY 1),
alive AS (SELECT c.* FROM cart c JOIN g USING (user_id) WHERE op <> 'd' AND event_id > coalesce(gone, -1))
SELECT user_id AS row_key, {_text('arg_max(num, event_id)')} AS sku_num,
  {_text('CASE WHEN bool_or(paid) THEN 1 END')} AS is_ordered,
  {_text(f'max(ts_ms) FILTER (WHERE paid) + {HOUR}')} AS operate_time
FROM alive GROUP BY user_id""",
    "dim_delete_by_keys": f"""SELECT {_text('s_suppkey')} AS row_key, s_name AS supplier_name, {_text('s_nationkey')} AS nation_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 0""",
    "log_dirty_records": """SELECT event_id, left(props, length(props) - 1) AS value FROM events WHERE event_type = 'error' AND NOT json_valid(left(props, length(props) - 1))""",
    # changes
    "cdc_filter_valid": f"WITH {ORDERS} SELECT id, op, ts_ms FROM o WHERE op <> 'd'",
    "cdc_filter_valid_deletes": f"WITH {ORDERS} SELECT id, op, ts_ms FROM o",
    "cdc_project_order": f"WITH {ORDERS} SELECT id, user_id, province_id, total_amount, ts_ms FROM o",
    "dim_column_prune": f"""WITH {ORDERS}, {USERS}, rows AS (
  SELECT 'dim_order_info' AS sink_table, id AS row_key, 'r' AS op, ts_ms, unnest(['id', 'order_status', 'province_id']) AS "column",
    unnest([id, order_status, province_id]) AS value FROM o
  UNION ALL
  SELECT 'dim_user_info', uid, 'r', ts_ms, unnest(['id', 'name', 'user_level', 'gender']), unnest([uid, uname, user_level, nullif(gender, 'home')]) FROM users)
SELECT * FROM rows""",
    "dim_route_tables": """SELECT 'dim_order_info' AS sink_table, 'r' AS op, count(*) AS n, count(DISTINCT o_orderkey) AS row_keys FROM orders
UNION ALL SELECT 'dim_user_info', 'r', count(*), count(DISTINCT c_custkey) FROM customer""",
    "dwd_cart_add": f"WITH {CARTS} SELECT id, user_id, sku_id, {_text('num')} AS sku_num, ts_ms FROM cart WHERE op = 'r'",
    "dwd_cart_add_delta": f"WITH {CART_ADDS} SELECT id, user_id, sku_id, sku_num, ts_ms FROM adds",
    "cart_change_typed": f"WITH {CART_TYPED} SELECT * FROM typed",
    "comment_flatten": f"""WITH {COMMENTS}
SELECT ts_ms, 'retail' AS db, 'comment_info' AS "table", '1' AS server_id, appraise, text AS "commentTxt", 'r' AS op, CAST(NULL AS VARCHAR) AS nick_name,
  ts_ms AS create_time, doc_id % 150 AS user_id, n_chars AS sku_id, doc_id AS id, n_chars % 97 AS spu_id, doc_id AS order_id, CAST(NULL AS VARCHAR) AS dic_name FROM c""",
    "cdc_after_or_before": f"WITH {ORDERS} SELECT op, ts_ms AS tm_ms, id, user_id, order_status FROM o",
    "cancel_filter": f"WITH {ORDERS} SELECT id, operate_time, ts_ms FROM o WHERE op = 'r' AND order_status IN ('1001', '1003')",
    "cancel_filter_reference": f"WITH {ORDERS} SELECT id, operate_time, ts_ms FROM o WHERE op <> 'd' AND (op = 'r' AND order_status = '1001' OR order_status = '1003')",
    "user_profile": f"WITH {USERS} SELECT * EXCLUDE (c_custkey) FROM users",
    "bean_to_snake_json": """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"'
  || CASE WHEN event_type = 'purchase' THEN ',"is_paid":"y"' ELSE '' END || '}' AS value FROM events""",
    # logs
    "log_split_err": f"WITH {FIXED} SELECT event_id, mid, fixed_new AS is_new, page_id, {_text('event_id % 100')} AS error_code, ms AS ts FROM fixed WHERE kind = 'error'",
    "log_split_start": f"WITH {FIXED} SELECT event_id, mid, fixed_new AS is_new, 'icon' AS entry, ms AS ts FROM fixed WHERE kind = 'signup'",
    "log_split_page": f"WITH {FIXED} SELECT event_id, mid, fixed_new AS is_new, page_id, last_page_id, item, during_time, ms AS ts FROM fixed WHERE kind <> 'signup'",
    "log_split_display": f"""WITH {LOGS} SELECT mid, page_id, {_text('event_id')} AS item, {_text('pos')} AS pos, ms AS ts
FROM (SELECT *, unnest(range(1, event_id % 4 + 1)) AS pos FROM logs WHERE kind = 'view')""",
    "log_split_action": f"""WITH {LOGS} SELECT mid, page_id, {_text('event_id')} AS item, {_text('pos')} AS pos
FROM (SELECT *, unnest(range(1, event_id % 3 + 1)) AS pos FROM logs WHERE kind = 'click')""",
    "login_filter": f"WITH {LOGS} SELECT event_id, mid AS uid, last_page_id, ms AS ts FROM logs WHERE last_page_id IN ('login', '')",
    "search_filter": f"WITH {LOGS} SELECT event_id, item, ms AS ts FROM logs WHERE kind = 'purchase'",
    # facts
    "dwd_order_detail": f"WITH {DETAIL} SELECT * EXCLUDE (o_ts_ms, order_status, operate_time, o_orderstatus, o_orderpriority) FROM od",
    "dwd_pay_success": f"""WITH {DETAIL} SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
  '110' || left(o_orderpriority, 1) AS payment_type_code, operate_time AS callback_time, sku_num, split_original_amount, split_activity_amount,
  split_coupon_amount, split_total_amount AS split_payment_amount, o_ts_ms AS ts_ms FROM od WHERE o_orderstatus = 'F'""",
    "dwd_order_cancel": f"""WITH {DETAIL} SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id, date_id,
  operate_time AS cancel_time, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, o_ts_ms AS ts_ms
FROM od WHERE order_status IN ('1001', '1003')""",
    "dwd_order_refund": f"""WITH {ORDERS}, {LINES} SELECT li.id, {_text('l_suppkey')} AS user_id, {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
  o.province_id, {_date('li.ts_ms')} AS date_id, {_text('li.ts_ms')} AS create_time, '1502' AS refund_type_code, '130' || l_linenumber AS refund_reason_type_code,
  'line ' || l_linestatus AS refund_reason_txt, {_text('qty')} AS refund_num, {_text('price')} AS refund_amount, li.ts_ms
FROM li JOIN o ON {_text('l_orderkey')} = o.id WHERE l_returnflag = 'R' AND order_status = '1006'""",
    "dwd_refund_pay_success": f"""WITH {ORDERS}, {LINES}, rp AS (SELECT * FROM li WHERE l_returnflag = 'R' AND l_linestatus = 'F')
SELECT rp.id, o.user_id, {_text('rp.l_orderkey')} AS order_id, {_text('rp.l_partkey')} AS sku_id, o.province_id, '110' || rp.l_linenumber AS payment_type_code,
  {_date(f'rp.ts_ms + {HOUR}')} AS date_id, {_text(f'rp.ts_ms + {HOUR}')} AS callback_time, {_text('ri.qty')} AS refund_num, {_text('rp.price')} AS refund_amount, rp.ts_ms
FROM rp JOIN rp ri ON rp.l_orderkey = ri.l_orderkey AND rp.l_partkey = ri.l_partkey JOIN o ON {_text('rp.l_orderkey')} = o.id WHERE order_status = '1006'""",
    "dwd_comment_dic": f"""WITH {COMMENTS}, {DIC} SELECT {_text('doc_id')} AS id, {_text('doc_id % 150')} AS user_id, {_text('n_chars')} AS sku_id, appraise,
  dic_name AS appraise_name, text AS comment_txt, ts_ms FROM c JOIN dic ON appraise = dic_code""",
    "interval_join_user": f"""WITH l AS (SELECT {_text('user_id')} AS uid, event_id, event_type, epoch_us(ts) // 1000 AS ts_ms FROM events),
r AS (SELECT {_text('user_id')} AS uid, {BODY.format(k='event_id')}, epoch_us(ts) // 1000 + (event_id % 5 - 2) * 180000 AS t FROM events)
SELECT l.*, height, unit_height, weight, unit_weight FROM l JOIN r ON l.uid = r.uid AND t BETWEEN ts_ms - 300000 AND ts_ms + 300000""",
    "interval_join_prefix": f"""WITH l AS (SELECT {_text('user_id')} AS uid, event_id, event_type, epoch_us(ts) // 1000 AS ts_ms FROM events),
r AS (SELECT {_text('user_id')} AS info_uid, {_text('150 + event_id % 50')} AS info_height, epoch_us(ts) // 1000 + (event_id % 5 - 2) * 45000 AS info_ts_ms FROM events)
SELECT * FROM l JOIN r ON uid = info_uid AND info_ts_ms BETWEEN ts_ms - 60000 AND ts_ms + 60000""",
    "dim_join_province": f"""WITH {ORDERS} SELECT id, user_id, province_id, ts_ms, n_name AS province_name
FROM o LEFT JOIN nation ON province_id = {_text('n_nationkey')} WHERE order_status = '1006'""",
    "dim_join_default": f"WITH {COMMENTS}, {DIC} SELECT {_text('doc_id')} AS id, appraise, ts_ms, coalesce(dic_name, 'N/A') AS dic_name FROM c LEFT JOIN dic ON appraise = dic_code",
    "dim_chain_sku": f"""WITH {SKU_DIMS}, q AS (SELECT {_text('l_partkey')} AS sku_id, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS sku_num FROM lineitem GROUP BY 1)
SELECT sku_id, sku_num, {SKU_COLUMNS} FROM q LEFT JOIN sku USING (sku_id)""",
    # summaries
    "dws_keyword_count": f"""WITH {LOGS}, k AS (SELECT ms, unnest(['search', 'brand' || (user_id % 7), json_extract_string(props, '$.k')]) AS keyword FROM logs WHERE kind = 'purchase')
SELECT {_bounds('w', HOUR)}, keyword, keyword_count FROM (SELECT ms // {HOUR} * {HOUR} AS w, keyword, count(*) AS keyword_count FROM k GROUP BY ALL)""",
    "dws_home_detail_uv": f"""WITH {LOGS}, f AS (SELECT mid, page_id, day, min(ms) AS ms FROM logs WHERE page_id IN ('home', 'good_detail') GROUP BY ALL)
SELECT {_bounds('w', HOUR)}, home_uv_ct, good_detail_uv_ct FROM (
  SELECT ms // {HOUR} * {HOUR} AS w, count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct, count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct FROM f GROUP BY 1)""",
    "dws_traffic_page_view": TRAFFIC,
    "dws_traffic_page_view_10s": _traffic(10_000),
    "dws_user_login": f"""WITH {LOGINS} SELECT {_bounds('w', HOUR)}, back_ct, uu_ct FROM (
  SELECT ts // {HOUR} * {HOUR} AS w, CAST(sum(back_ct) AS BIGINT) AS back_ct, CAST(sum(uu_ct) AS BIGINT) AS uu_ct FROM logins GROUP BY 1)""",
    "dws_cart_add_uu": f"""WITH {CART_ADDS}, f AS (SELECT user_id, ts_ms // {DAY} AS d, min(ts_ms) AS ms FROM adds GROUP BY ALL)
SELECT {_bounds('w', HOUR)}, cart_add_uu_ct FROM (SELECT ms // {HOUR} * {HOUR} AS w, count(*) AS cart_add_uu_ct FROM f GROUP BY 1)""",
    "dws_province_order": f"{PROVINCE} SELECT * FROM named",
    "dws_sku_order": f"""WITH {VERSIONS}, {SKU_DIMS}, w AS (
  SELECT ts_ms // {DAY} * {DAY} AS w, sku_id, CAST(sum({_money('split_original_amount')}) AS DECIMAL(26,2)) AS original_amount,
    CAST(sum({_money('split_activity_amount')}) AS DECIMAL(26,2)) AS activity_reduce_amount,
    CAST(sum({_money('split_coupon_amount')}) AS DECIMAL(26,2)) AS coupon_reduce_amount,
    CAST(sum({_money('split_total_amount')}) AS DECIMAL(26,2)) AS order_amount
  FROM v WHERE rn = 1 GROUP BY ALL)
SELECT {_bounds('w', DAY)}, sku_id, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount, {SKU_COLUMNS} FROM w LEFT JOIN sku USING (sku_id)""",
    "report_channel_uv": f"SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct FROM ({TRAFFIC}) GROUP BY 1",
    "report_province_amount": f"{PROVINCE} SELECT province_name, CAST(sum(order_amount) AS DECIMAL(36,2)) AS order_amount FROM named GROUP BY 1",
    # state and duplicates
    "fix_is_new": f"WITH {FIXED} SELECT event_id, mid, fixed_new AS is_new, ms AS ts FROM fixed",
    "first_visit_of_day": f"""WITH {LOGS} SELECT mid, strftime(day, '%Y-%m-%d') AS visit_date, ms AS ts, page_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY ms, event_id) AS rn FROM logs) WHERE rn = 1""",
    "login_return_user": f"WITH {LOGINS} SELECT * FROM logins",
    "first_cart_of_day": f"""WITH {CART_ADDS} SELECT user_id, ts_ms, id, sku_id, sku_num FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts_ms // {DAY} ORDER BY ts_ms, event_id) AS rn FROM adds) WHERE rn = 1""",
    "dedup_retract": f"WITH {RETRACTED} SELECT * FROM r",
    "dedup_latest": f"WITH {VERSIONS} SELECT id, order_id, sku_id, province_id, split_total_amount, ts_ms, part_no, supp_no FROM v WHERE rn = 1",
    "dedup_exact_key": f"""SELECT min(doc_id) AS doc_id, ('0x' || substr(md5(text), 1, 15))::BIGINT AS order_id, {DAY0} + (n_chars % 1000) * 60000 AS ts_ms FROM documents GROUP BY 2, 3""",
    "dedup_bloom": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    # functions
    "fn_epoch_format": f"SELECT event_id, {_date('epoch_us(ts) // 1000')} AS d, {_dt('epoch_us(ts) // 1000')} AS dt, {_dt('epoch_us(ts) // 1000', '%Y%m%d')} AS c FROM events",
    "fn_text_to_epoch": "SELECT event_id, epoch_ms(date_trunc('second', ts)) AS dt_ms, epoch_ms(CAST(date_trunc('day', ts) AS TIMESTAMP)) AS d_ms FROM events",
    "fn_epoch_day": f"WITH {BIRTHS} SELECT c_custkey, {_text('b')} AS birthday FROM births",
    "fn_age": f"WITH {BIRTHS} SELECT c_custkey, {_AGE} AS age FROM births",
    "fn_decade": f"WITH {BIRTHS} SELECT c_custkey, CAST(year(b) // 10 * 10 AS INTEGER) AS decade FROM births",
    "fn_zodiac": f"WITH {BIRTHS} SELECT c_custkey, {_ZODIAC} AS zodiac_sign FROM births",
    "fn_decimal_amount": f"WITH {LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_text(_money('qty') + ' * price')} AS amount FROM li",
    "fn_md5_key": "SELECT c_custkey, md5(c_name) AS row_key, 'dim_user:' || c_name AS cache_key FROM customer",
    "fn_last_token": f"SELECT doc_id, {LAST} AS token FROM documents",
    # moderation
    "keyword_explode": r"""SELECT keyword, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS keyword FROM documents) GROUP BY 1""",
    "moderate_exact": f"""WITH {CHECK} SELECT doc_id, CAST(hit AS INTEGER) AS is_violation, CASE WHEN hit THEN 'P0' ELSE '' END AS violation_grade,
  CASE WHEN hit THEN token ELSE '' END AS violation_msg FROM first_check""",
    "moderate_contains": f"WITH {CHECK} SELECT doc_id, is_violation, violation_grade, violation_msg FROM both_checks",
    "words_batch_check": f"""SELECT DISTINCT {LAST} AS word, length({LAST}) > 2 AND length({LAST}) <= 12 AS banned FROM documents""",
    # jobs
    "job_ban_list": f"""WITH {CHECK} SELECT order_id, user_id, consignee, ts_ms, {_dt('ts_ms', '%Y%m%d')} AS ds, is_violation, violation_grade, violation_msg
FROM both_checks JOIN (SELECT min(doc_id) AS doc_id FROM first_check GROUP BY order_id, ts_ms) USING (doc_id)""",
    "job_dim_load": f"WITH {USERS} SELECT uid AS row_key, uid AS id, uname AS name, user_level, nullif(gender, 'home') AS gender FROM users",
    "job_comment_enrich": f"""WITH {COMMENTS}, {DIC}
SELECT ts_ms, 'retail' AS db, 'comment_info' AS "table", '1' AS server_id, appraise, 'r' AS op, CAST(NULL AS VARCHAR) AS nick_name, ts_ms AS create_time,
  doc_id % 150 AS user_id, n_chars AS sku_id, doc_id AS id, n_chars % 97 AS spu_id, doc_id AS order_id, coalesce(dic_name, 'N/A') AS dic_name,
  'r' AS info_op, ts_ms + (doc_id % 5 - 2) * 45000 AS info_tm_ms, doc_id AS info_id, {_text('n_chars')} AS info_consignee, {_dt('ts_ms', '%Y%m%d')} AS ds
FROM c LEFT JOIN dic ON appraise = dic_code WHERE abs(doc_id % 5 - 2) * 45000 <= 60000""",
    "job_user_label": f"""WITH {USERS} SELECT * EXCLUDE (c_custkey), {BODY.format(k='c_custkey')} FROM users WHERE abs(c_custkey % 5 - 2) * 180000 <= 300000""",
}
_PARTIAL = f"""WITH {CART_TYPED}
SELECT user_id, ds, arg_max(is_ordered, id) AS is_ordered, arg_max(sku_num, id) AS sku_num, arg_max(sku_name, id) AS sku_name,
  arg_max(operate_time, id) FILTER (WHERE operate_time IS NOT NULL) AS operate_time, max(ts_ms) AS ts_ms, max(id) AS id
FROM typed GROUP BY user_id, ds"""
EXPECTED["partial_update_merge"] = _PARTIAL
EXPECTED["sink_partial_update_table"] = _PARTIAL
EXPECTED["sink_dim_merge_table"] = EXPECTED["dim_upsert_merge"]
EXPECTED["src_cdc_typed_view"] = EXPECTED["src_cdc_map_view"]
EXPECTED["cdc_snapshot_then_changes"] = """WITH c AS (
  SELECT c_custkey::BIGINT AS id, c_acctbal AS balance, 'r' AS op, -1::BIGINT AS position FROM customer
  UNION ALL
  SELECT event_id * 7919 % 1600, CASE WHEN event_type <> 'error' THEN value END, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END, event_id
  FROM events),
m AS (SELECT *, (id // 100) % 16 * 50 + 320 AS high FROM c),
s AS (SELECT id, high, arg_max({'op': op, 'balance': balance}, position) AS r FROM m WHERE position <= high GROUP BY id, high)
SELECT id, r.balance AS balance, 'r' AS op, high AS position FROM s WHERE r.op <> 'd'
UNION ALL SELECT id, balance, op, position FROM m WHERE position > high AND position >= 0"""
EXPECTED["keyword_lexicon"] = """WITH RECURSIVE names AS (SELECT DISTINCT lower(p_name) AS name, replace(lower(p_name), ' ', '') AS t FROM part),
weights AS (SELECT word, count(*) AS weight FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) WHERE word <> '' GROUP BY 1),
lex AS (SELECT word, max(weight) AS weight FROM (SELECT * FROM weights UNION ALL SELECT unnest([word[1:2], word[3:]]), 1 FROM weights) WHERE word <> '' GROUP BY 1),
spots AS (SELECT DISTINCT t, unnest(range(length(t))) AS i FROM names),
hits AS (SELECT t, i, word, weight FROM spots JOIN lex ON starts_with(substr(t, i + 1), word)),
options AS (SELECT * FROM hits UNION ALL SELECT t, i, substr(t, i + 1, 1), 0 FROM spots ANTI JOIN hits USING (t, i)),
paths AS (
  SELECT name, t, 0::BIGINT AS i, 0::BIGINT AS total, []::BIGINT[] AS ends, []::VARCHAR[] AS words FROM names
  UNION ALL
  SELECT name, p.t, p.i + length(word), total + weight, list_append(ends, p.i + length(word)), list_append(words, word)
  FROM paths p JOIN options o ON p.t = o.t AND p.i = o.i),
best AS (SELECT words, row_number() OVER (PARTITION BY name ORDER BY total DESC, len(ends), ends DESC) AS place FROM paths WHERE i = length(t))
SELECT keyword, count(*) AS n FROM (SELECT unnest(words) AS keyword FROM best WHERE place = 1) GROUP BY 1"""
