"""DuckDB twins of the registered queries (independent SQL formulations).

The stateful rules are written here the literal way -- ``lag`` / ``first_value``
over an ordered window -- while the Spark side uses combinable aggregates, so
agreement checks the rewrite. Window starts are computed from epoch
milliseconds (epoch-aligned, like Spark's ``window``).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

PAGE_LOG = """
page_log AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, epoch_us(ts) // 1000 AS ts_ms,
         'mid_' || CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
         'v2.1.' || CAST(user_id % 3 AS VARCHAR) AS vc,
         CASE user_id % 3 WHEN 0 THEN 'appstore' WHEN 1 THEN 'xiaomi' ELSE 'oppo' END AS ch,
         CAST(user_id % 5 AS VARCHAR) AS ar,
         CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'login' ELSE 'mine' END AS page_id,
         CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'login' END
              WHEN event_type = 'click' THEN 'search' ELSE 'home' END AS last_page_id,
         CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS item,
         CASE WHEN event_type = 'click' THEN 'keyword' END AS item_type,
         CAST(ROUND(value * 1000) AS BIGINT) AS during_time
  FROM events
)"""


def win_cols(ts_ms: str, size_ms: int, edt: bool = True) -> str:
    """stt / edt / cur_date of the epoch-aligned tumbling window."""
    start = f"epoch_ms(({ts_ms}) // {size_ms} * {size_ms})"
    end = f"epoch_ms(({ts_ms}) // {size_ms} * {size_ms} + {size_ms})"
    s = f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, "
    if edt:
        s += f"strftime({end}, '%Y-%m-%d %H:%M:%S') AS edt, "
    s += f"strftime({start}, '%Y-%m-%d') AS cur_date"
    return s


def win_key(ts_ms: str, size_ms: int) -> str:
    return f"({ts_ms}) // {size_ms}"


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# -- traffic layer ----------------------------------------------------------

def _traffic(size_ms: int) -> str:
    return f"""
WITH {PAGE_LOG},
flagged AS (
  SELECT *, lag(strftime(ts, '%Y-%m-%d')) OVER (PARTITION BY mid ORDER BY ts, event_id) AS prev_day
  FROM page_log
),
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms, vc, ch, ar, is_new,
         CAST(sum(CASE WHEN prev_day IS DISTINCT FROM strftime(ts, '%Y-%m-%d') THEN 1 ELSE 0 END) AS BIGINT) AS uv_ct,
         CAST(sum(CASE WHEN last_page_id IS NULL OR last_page_id = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
         CAST(count(*) AS BIGINT) AS pv_ct,
         CAST(sum(during_time) AS BIGINT) AS dur_sum
  FROM flagged GROUP BY 1, vc, ch, ar, is_new
)
SELECT {win_cols('any_ms', size_ms)}, vc, ch, ar, is_new, uv_ct, sv_ct, pv_ct, dur_sum FROM g
"""


register("traffic_vc_ch_ar_isnew_window", _traffic(10_000))
register("traffic_vc_ch_ar_isnew_window_1h", _traffic(3_600_000))

register("visitor_is_new_repair", f"""
WITH {PAGE_LOG},
s AS (
  SELECT event_id, mid, ts, is_new,
         first_value(is_new) OVER w AS first_flag,
         first_value(ts) OVER w AS first_ts
  FROM page_log
  WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT event_id, mid,
       CASE WHEN is_new = '1' AND
                 (CASE WHEN first_flag = '1' THEN strftime(first_ts, '%Y-%m-%d')
                       ELSE strftime(CAST(first_ts AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') END)
                 <> strftime(ts, '%Y-%m-%d')
            THEN '0' ELSE is_new END AS is_new
FROM s
""")


def _home_detail(size_ms: int) -> str:
    return f"""
WITH {PAGE_LOG},
f AS (
  SELECT *, lag(strftime(ts, '%Y-%m-%d')) OVER (PARTITION BY mid, page_id ORDER BY ts, event_id) AS prev_day
  FROM page_log WHERE page_id IN ('home', 'good_detail')
),
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms,
    CAST(sum(CASE WHEN page_id = 'home' AND prev_day IS DISTINCT FROM strftime(ts, '%Y-%m-%d') THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
    CAST(sum(CASE WHEN page_id = 'good_detail' AND prev_day IS DISTINCT FROM strftime(ts, '%Y-%m-%d') THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
  FROM f GROUP BY 1
)
SELECT {win_cols('any_ms', size_ms)}, home_uv_ct, good_detail_uv_ct FROM g
WHERE home_uv_ct <> 0 OR good_detail_uv_ct <> 0
"""


register("home_detail_uv_window", _home_detail(3_000))
register("home_detail_uv_window_1d", _home_detail(86_400_000))


def _login(size_ms: int) -> str:
    return f"""
WITH {PAGE_LOG},
logins AS (
  SELECT * FROM page_log
  WHERE uid IS NOT NULL AND uid <> '' AND (last_page_id = 'login' OR last_page_id IS NULL OR last_page_id = '')
),
s AS (
  SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY uid ORDER BY ts, event_id) AS prev_date
  FROM logins
),
flags AS (
  SELECT ts_ms,
         CASE WHEN prev_date IS NULL OR prev_date <> CAST(ts AS DATE) THEN 1 ELSE 0 END AS uu,
         CASE WHEN prev_date IS NOT NULL AND date_diff('day', prev_date, CAST(ts AS DATE)) >= 8 THEN 1 ELSE 0 END AS back
  FROM s
),
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms,
         CAST(sum(back) AS BIGINT) AS back_ct, CAST(sum(uu) AS BIGINT) AS uu_ct
  FROM flags WHERE uu <> 0 OR back <> 0 GROUP BY 1
)
SELECT {win_cols('any_ms', size_ms)}, back_ct, uu_ct FROM g WHERE uu_ct <> 0 OR back_ct <> 0
"""


register("user_login_window", _login(3 * 3_600_000))
register("user_login_window_1d", _login(86_400_000))


# -- fact layer ---------------------------------------------------------------

def ms(col: str) -> str:
    """Epoch milliseconds of a timestamp column (truncating, like Spark)."""
    return f"(epoch_us({col}) // 1000)"


def vc(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def d2(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(16,2))"


BASE_DIC_SQL = """
base_dic AS (
  SELECT * FROM (VALUES
    ('1101', 'alipay'), ('1102', 'wechat'), ('1103', 'unionpay'),
    ('1201', 'good'), ('1202', 'medium'), ('1203', 'bad'),
    ('1301', 'quality issue'), ('1302', 'wrong size'), ('1303', 'other reason'),
    ('1501', 'refund only'), ('1502', 'return and refund')) AS d(dic_code, dic_name)
)"""

DID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"

ORDER_DETAIL = f"""
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, p.p_name, p.p_retailprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
od_ranked AS (
  SELECT {DID} AS id, {vc('l_orderkey')} AS order_id, {vc('l_partkey')} AS sku_id, p_name AS sku_name,
         {vc(ms('o_orderdate'))} AS create_time, {ms('o_orderdate')} AS create_ms,
         {vc(d2('l_quantity'))} AS sku_num,
         {vc(f"{d2('l_quantity')} * {d2('p_retailprice')}")} AS split_original_amount,
         {vc(f"{d2('l_extendedprice')} * {d2('l_discount')}")} AS split_activity_amount,
         {vc(f"{d2('l_extendedprice')} * {d2('l_tax')}")} AS split_coupon_amount,
         {vc(f"{d2('l_extendedprice')} - {d2('l_extendedprice')} * {d2('l_discount')} - {d2('l_extendedprice')} * {d2('l_tax')}")} AS split_total_amount,
         {ms('l_shipdate')} + (l_orderkey % 60) * 1000 AS ts_ms,
         CASE WHEN l_partkey % 17 = 0 THEN 2 ELSE 1 END AS copies,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                                     l_quantity DESC, l_discount DESC, l_tax DESC) AS rn
  FROM lines
),
act AS (
  SELECT {DID} AS aid, {vc('l_linenumber + 100')} AS activity_id,
         {vc('l_linenumber * 10 + l_suppkey % 3')} AS activity_rule_id
  FROM lineitem WHERE l_discount >= 0.05
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_suppkey DESC) = 1
),
cou AS (
  SELECT DISTINCT {DID} AS cid, {vc('l_linenumber + 200')} AS coupon_id FROM lineitem WHERE l_tax >= 0.05
),
oi AS (
  SELECT {vc('o_orderkey')} AS oid, {vc('o_custkey')} AS user_id,
         {vc('CASE WHEN o_orderkey % 13 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END')} AS province_id,
         o_orderstatus, o_orderdate, o_orderkey, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey
),
detail AS (
  SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
         strftime(epoch_ms(create_ms), '%Y-%m-%d') AS date_id, create_time, create_ms, sku_num,
         split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, ts_ms
  FROM od_ranked JOIN oi ON order_id = oid
  LEFT JOIN act ON id = aid LEFT JOIN cou ON id = cid
  WHERE rn = 1
)"""

register("order_detail_fact", f"""
WITH {ORDER_DETAIL}
SELECT * EXCLUDE (create_ms) FROM detail
""")

register("order_cancel_fact", f"""
WITH {ORDER_DETAIL},
cancel AS (
  SELECT oid AS c_oid, {ms('o_orderdate')} + 600000 AS cancel_ms FROM oi WHERE o_orderstatus = 'F'
)
SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
       strftime(epoch_ms(cancel_ms), '%Y-%m-%d') AS date_id, {vc('cancel_ms')} AS cancel_time, sku_num,
       split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount,
       cancel_ms AS ts_ms
FROM detail JOIN cancel ON order_id = c_oid
""")


def _payment(interval: bool) -> str:
    cond = ""
    if interval:
        cond = ("AND detail.create_ms >= pay.pay_ms - 30 * 60000 "
                "AND detail.create_ms <= pay.pay_ms + 5000")
    return f"""
WITH {ORDER_DETAIL}, {BASE_DIC_SQL},
pay AS (
  SELECT oid AS p_oid, {vc('1101 + o_orderkey % 3')} AS payment_type_code,
         {ms('o_orderdate')} + (o_orderkey % 60 - 10) * 60000 AS pay_ms
  FROM oi WHERE o_orderstatus = 'F'
)
SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
       coupon_id, payment_type_code, dic_name AS payment_type_name, {vc('pay_ms')} AS callback_time, sku_num,
       split_original_amount, split_activity_amount, split_coupon_amount,
       split_total_amount AS split_payment_amount, pay_ms AS ts_ms
FROM pay JOIN detail ON detail.order_id = pay.p_oid {cond}
JOIN base_dic ON payment_type_code = dic_code
"""


register("payment_fact", _payment(False))
register("payment_fact_interval", _payment(True))

register("payment_fact_versioned", f"""
WITH {ORDER_DETAIL}, {BASE_DIC_SQL},
quarters AS (SELECT date_trunc('quarter', o_orderdate) AS q, min({ms('o_orderdate')}) AS since FROM orders GROUP BY 1),
dic AS (
  SELECT dic_code, dic_name || '@' || {vc('year(q)')} || 'Q' || {vc('quarter(q)')} AS dic_name, since,
         lead(since) OVER (PARTITION BY dic_code ORDER BY since) AS upto,
         quarter(q) = 3 AND dic_code LIKE '%3' AS gone
  FROM quarters, base_dic
  WHERE NOT (dic_code LIKE '%2' AND since = (SELECT min(since) FROM quarters))
),
pay AS (
  SELECT oid AS p_oid, {vc('1101 + o_orderkey % 3')} AS payment_type_code,
         {ms('o_orderdate')} + (o_orderkey % 60 - 10) * 60000 AS pay_ms
  FROM oi WHERE o_orderstatus = 'F'
)
SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
       coupon_id, payment_type_code, dic_name AS payment_type_name, {vc('pay_ms')} AS callback_time, sku_num,
       split_original_amount, split_activity_amount, split_coupon_amount,
       split_total_amount AS split_payment_amount, pay_ms AS ts_ms
FROM pay JOIN detail ON detail.order_id = pay.p_oid
JOIN dic ON payment_type_code = dic_code AND NOT gone AND since <= pay_ms AND (upto IS NULL OR pay_ms < upto)
""")

# The literal way: at every time at which any side of a detail changes, look up
# the last version of each side, and compare with the row before.
register("order_detail_changes", f"""
WITH {ORDER_DETAIL},
dv AS (
  SELECT id, order_id, sku_id, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, ts_ms
  FROM od_ranked QUALIFY row_number() OVER (PARTITION BY id, ts_ms ORDER BY rn) = 1
),
av AS (
  SELECT {DID} AS id, {vc('l_linenumber + 100')} AS activity_id, {vc('l_linenumber * 10 + l_suppkey % 3')} AS activity_rule_id,
         {ms('l_shipdate')} + (l_orderkey % 60) * 1000 AS ts_ms
  FROM lineitem WHERE l_discount >= 0.05
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate ORDER BY l_suppkey DESC, l_linenumber DESC) = 1
),
cv AS (
  SELECT DISTINCT {DID} AS id, {vc('l_linenumber + 200')} AS coupon_id, {ms('l_shipdate')} + (l_orderkey % 60) * 1000 AS ts_ms
  FROM lineitem WHERE l_tax >= 0.05
),
ov AS (
  SELECT {vc('o_orderkey')} AS oid, {vc('o_custkey')} AS user_id, {vc('c_nationkey')} AS province_id, {ms('o_orderdate')} AS ts_ms
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT {vc('o_orderkey')}, {vc('o_custkey')}, {vc('(c_nationkey + 1) % 25')}, {ms('o_orderdate')} + 60000
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 13 = 0
),
times AS (
  SELECT id, ts_ms FROM dv UNION SELECT id, ts_ms FROM av UNION SELECT id, ts_ms FROM cv
  UNION SELECT d.id, o.ts_ms FROM (SELECT DISTINCT id, order_id FROM dv) d JOIN ov o ON d.order_id = o.oid
),
states AS (
  SELECT t.id, t.ts_ms AS change_ms, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, sku_num,
         split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount
  FROM times t
  ASOF LEFT JOIN dv ON t.id = dv.id AND t.ts_ms >= dv.ts_ms
  ASOF LEFT JOIN ov ON dv.order_id = ov.oid AND t.ts_ms >= ov.ts_ms
  ASOF LEFT JOIN av ON t.id = av.id AND t.ts_ms >= av.ts_ms
  ASOF LEFT JOIN cv ON t.id = cv.id AND t.ts_ms >= cv.ts_ms
  WHERE dv.id IS NOT NULL AND ov.oid IS NOT NULL
),
packed AS (
  SELECT id, change_ms, row(order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, sku_num,
                            split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount) AS s FROM states
),
paired AS (SELECT id, change_ms, s, lag(s) OVER (PARTITION BY id ORDER BY change_ms) AS before,
                  lag(change_ms) OVER (PARTITION BY id ORDER BY change_ms) IS NOT NULL AS later FROM packed),
signed AS (
  SELECT id, change_ms, s, 1 AS sign FROM paired WHERE NOT later OR s IS DISTINCT FROM before
  UNION ALL
  SELECT id, change_ms, before, -1 FROM paired WHERE later AND s IS DISTINCT FROM before
)
SELECT id, s[1] AS order_id, s[2] AS user_id, s[3] AS sku_id, s[4] AS province_id, s[5] AS activity_id, s[6] AS activity_rule_id,
       s[7] AS coupon_id, s[8] AS sku_num, s[9] AS split_original_amount, s[10] AS split_activity_amount,
       s[11] AS split_coupon_amount, s[12] AS split_total_amount, change_ms, sign
FROM signed
""")

register("refund_fact", f"""
WITH {BASE_DIC_SQL},
r AS (
  SELECT l_orderkey, l_linenumber, min(o_custkey) AS custkey, min(l_partkey) AS partkey,
         sum(l_quantity) AS qty, max(l_extendedprice) AS price, max(l_shipdate) AS shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber
),
oi AS (
  SELECT {vc('o_orderkey')} AS oid, {vc('c_nationkey')} AS province_id
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'
),
ri AS (
  SELECT {DID} AS id, {vc('custkey')} AS user_id, {vc('l_orderkey')} AS order_id, {vc('partkey')} AS sku_id,
         {vc('1501 + l_linenumber % 2')} AS refund_type_code, {vc('CAST(qty AS BIGINT)')} AS refund_num,
         {vc(d2('price'))} AS refund_amount, {vc('1301 + partkey % 3')} AS refund_reason_type_code,
         'reason for line ' || {DID} AS refund_reason_txt, {ms('shipdate')} AS create_ms
  FROM r
)
SELECT id, user_id, order_id, sku_id, province_id, strftime(epoch_ms(create_ms), '%Y-%m-%d') AS date_id,
       {vc('create_ms')} AS create_time, refund_type_code, d1.dic_name AS refund_type_name,
       refund_reason_type_code, d2.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num,
       refund_amount, create_ms AS ts_ms
FROM ri JOIN oi ON order_id = oid
JOIN base_dic d1 ON refund_type_code = d1.dic_code
JOIN base_dic d2 ON refund_reason_type_code = d2.dic_code
""")

register("comment_fact", f"""
WITH {BASE_DIC_SQL}
SELECT {vc('event_id')} AS id, {vc('user_id')} AS user_id, json_extract_string(props, '$.k') AS sku_id,
       {vc('1201 + event_id % 4')} AS appraise, dic_name AS appraise_name,
       'comment ' || {vc('event_id')} AS comment_txt, {ms('ts')} AS ts_ms
FROM events JOIN base_dic ON {vc('1201 + event_id % 4')} = dic_code
WHERE event_type = 'view'
""")

register("cart_add_fact", f"""
WITH c AS (
  SELECT event_id, user_id, ts, json_extract_string(props, '$.k') AS sku_id,
         CASE WHEN event_id % 2 = 0 THEN 'c' ELSE 'u' END AS op,
         CASE WHEN event_id % 2 = 0 OR event_id % 11 = 0 THEN NULL ELSE {vc('event_id % 5')} END AS old_num,
         {vc('event_id % 7 + 1')} AS sku_num
  FROM events WHERE event_type = 'purchase'
)
SELECT {vc('event_id')} AS id, {vc('user_id')} AS user_id, sku_id,
       CASE WHEN op = 'c' THEN sku_num ELSE {vc('TRY_CAST(sku_num AS INTEGER) - TRY_CAST(old_num AS INTEGER)')} END AS sku_num,
       {ms('ts')} AS ts
FROM c
WHERE op = 'c' OR (op = 'u' AND old_num IS NOT NULL AND TRY_CAST(sku_num AS INTEGER) > TRY_CAST(old_num AS INTEGER))
""")


# -- order windows, dedup ------------------------------------------------------

AMT = "DECIMAL(20,4)"


def _amount_cols(prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{c} AS {AMT}) AS {c}" for c in
                     ("split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"))


register("order_dedup_latest", f"""
WITH {ORDER_DETAIL}
SELECT id, ts_ms, {_amount_cols()} FROM od_ranked JOIN oi ON order_id = oid WHERE rn = 1
""")

register("order_dedup_retract", f"""
WITH {ORDER_DETAIL},
v AS (SELECT id, ts_ms, rn, copies, {_amount_cols()} FROM od_ranked JOIN oi ON order_id = oid)
SELECT id, ts_ms, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount,
       1 AS sign FROM v, range(2) AS r(k) WHERE k < copies
UNION ALL
SELECT id, ts_ms, -split_original_amount, -split_activity_amount, -split_coupon_amount, -split_total_amount,
       -1 AS sign FROM v, range(2) AS r(k) WHERE k < copies - (CASE WHEN rn = 1 THEN 1 ELSE 0 END)
""")


def _hold(rows: str, key: str, hold_ms: int, cols: str) -> str:
    """``rows`` (key, ts_ms, one row per key and ms): holds opened one after the
    other by walking each key's sorted times."""
    return f"""
times AS (SELECT {key} AS k, list_sort(list(DISTINCT ts_ms)) AS rest FROM {rows} GROUP BY 1),
holds AS (
  SELECT k, rest[1] AS hold_start, list_filter(rest, lambda x: x >= rest[1] + {hold_ms}) AS rest FROM times
  UNION ALL
  SELECT k, rest[1], list_filter(rest, lambda x: x >= rest[1] + {hold_ms}) FROM holds WHERE len(rest) > 0
)
SELECT {cols}, hold_start, hold_start + {hold_ms} AS flush_ms
FROM holds JOIN {rows} r ON r.{key} = holds.k AND r.ts_ms >= hold_start AND r.ts_ms < hold_start + {hold_ms}
QUALIFY row_number() OVER (PARTITION BY holds.k, hold_start ORDER BY r.ts_ms DESC) = 1
"""


register("order_dedup_hold", f"""
WITH RECURSIVE {ORDER_DETAIL},
v AS (
  SELECT id, ts_ms, {_amount_cols()} FROM od_ranked JOIN oi ON order_id = oid
  QUALIFY row_number() OVER (PARTITION BY id, ts_ms ORDER BY rn) = 1
),""" + _hold("v", "id", 5000, "r.*"))

register("visitor_page_hold", f"""
WITH RECURSIVE {PAGE_LOG.strip()},
v AS (SELECT mid, ts_ms, event_id, page_id FROM page_log QUALIFY row_number() OVER (PARTITION BY mid, ts_ms ORDER BY event_id DESC) = 1),"""
         + _hold("v", "mid", 6 * 3_600_000, "r.*"))


def _province(size_ms: int) -> str:
    return f"""
WITH {ORDER_DETAIL},
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms, province_id,
         CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
         CAST(sum(CAST(split_total_amount AS {AMT})) AS DECIMAL(38,4)) AS order_amount
  FROM detail GROUP BY 1, province_id
)
SELECT {win_cols('any_ms', size_ms)}, province_id, n_name AS province_name, order_count, order_amount
FROM g LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)
"""


register("province_order_window", _province(2_000))
register("province_order_window_1d", _province(86_400_000))

WIDE_SKU = """
c3 AS (SELECT p_type AS c3_id, lower(p_type) AS c3_name, min('size' || CAST(p_size % 5 AS VARCHAR)) AS c2_id
       FROM part GROUP BY p_type),
wide AS (
  SELECT CAST(p_partkey AS VARCHAR) AS w_sku_id, p_name AS sku_name, p_name AS spu_id, p_name AS spu_name,
         p_brand AS trademark_id, p_brand AS trademark_name, c3_id AS category3_id, c3_name AS category3_name,
         c2_id AS category2_id, 'size band ' || CAST(r.r_regionkey AS VARCHAR) AS category2_name,
         CAST(r.r_regionkey AS VARCHAR) AS category1_id, r.r_name AS category1_name
  FROM part LEFT JOIN c3 ON p_type = c3_id
  LEFT JOIN region r ON c2_id = 'size' || CAST(r.r_regionkey AS VARCHAR)
)"""


def _sku(size_ms: int) -> str:
    sums = ", ".join(f"CAST(sum(CAST({src} AS {AMT})) AS DECIMAL(38,4)) AS {dst}" for src, dst in [
        ("split_original_amount", "original_amount"), ("split_activity_amount", "activity_reduce_amount"),
        ("split_coupon_amount", "coupon_reduce_amount"), ("split_total_amount", "order_amount")])
    return f"""
WITH {ORDER_DETAIL}, {WIDE_SKU},
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms, sku_id, {sums}
  FROM detail GROUP BY 1, sku_id
)
SELECT {win_cols('any_ms', size_ms)}, trademark_id, trademark_name, category1_id, category1_name,
       category2_id, category2_name, category3_id, category3_name, sku_id, wide.sku_name, spu_id, spu_name,
       original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount
FROM g LEFT JOIN wide ON sku_id = w_sku_id
"""


register("sku_order_window", _sku(10_000))
register("sku_order_window_1d", _sku(86_400_000))


def _cart_uu(size_ms: int) -> str:
    return f"""
WITH c AS (
  SELECT event_id, user_id, ts, {ms('ts')} AS ts_ms,
         CASE WHEN event_id % 2 = 0 THEN 'c' ELSE 'u' END AS op,
         CASE WHEN event_id % 2 = 0 OR event_id % 11 = 0 THEN NULL ELSE {vc('event_id % 5')} END AS old_num,
         {vc('event_id % 7 + 1')} AS sku_num
  FROM events WHERE event_type = 'purchase'
),
adds AS (
  SELECT * FROM c
  WHERE op = 'c' OR (op = 'u' AND old_num IS NOT NULL AND TRY_CAST(sku_num AS INTEGER) > TRY_CAST(old_num AS INTEGER))
),
f AS (
  SELECT *, lag(strftime(epoch_ms(ts_ms), '%Y-%m-%d')) OVER (PARTITION BY user_id ORDER BY ts_ms, {vc('event_id')}) AS prev_day
  FROM adds
),
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms, CAST(count(*) AS BIGINT) AS cart_add_uu_ct
  FROM f WHERE prev_day IS DISTINCT FROM strftime(epoch_ms(ts_ms), '%Y-%m-%d') GROUP BY 1
)
SELECT {win_cols('any_ms', size_ms)}, cart_add_uu_ct FROM g
"""


register("cart_add_uu_window", _cart_uu(5_000))
register("cart_add_uu_window_1d", _cart_uu(86_400_000))


# -- keywords and text -----------------------------------------------------------

TOKENS = r"regexp_extract_all(lower(text), '(?:[^\P{L}一-龥]|\p{M}|\p{N})+|[一-龥]+')"


def _keyword(size_ms: int) -> str:
    return f"""
WITH {PAGE_LOG},
s AS (SELECT ts_ms, item FROM page_log
      WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL),
tok AS (SELECT CAST(doc_id AS VARCHAR) AS ref, unnest({TOKENS}) AS keyword FROM documents),
g AS (
  SELECT {win_key('ts_ms', size_ms)} AS wk, min(ts_ms) AS any_ms, keyword, CAST(count(*) AS BIGINT) AS keyword_count
  FROM s JOIN tok ON s.item = tok.ref GROUP BY 1, keyword
)
SELECT {win_cols('any_ms', size_ms, edt=False)}, keyword, keyword_count FROM g
"""


register("keyword_window", _keyword(1_000))
register("keyword_window_1d", _keyword(86_400_000))

register("keyword_tokens", f"""
SELECT keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM (SELECT unnest({TOKENS}) AS keyword FROM documents) GROUP BY keyword
""")

# Best cuts of each token's suffixes, one position after the other; best[k] is
# the suffix that starts k - 1 code points behind the position.
register("keyword_segment", f"""
WITH RECURSIVE runs AS (
  SELECT run, count(*) AS n FROM (SELECT unnest({TOKENS}) AS run FROM documents) GROUP BY 1
),
dict AS (SELECT run AS word FROM runs WHERE length(run) BETWEEN 2 AND 8 AND n >= (SELECT count(*) / 100 FROM documents)),
lattice AS (
  SELECT run, list({{'i': i, 'l': l}}) AS edges
  FROM (SELECT run, i, unnest(range(2, least(8, length(run) - i + 1) + 1)) AS l
        FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM runs))
  JOIN dict ON substr(run, i, l) = word GROUP BY run
),
dp AS (
  SELECT run, n, coalesce(edges, []) AS edges, length(run) + 1 AS pos,
         [{{'loose': 0::BIGINT, 'pieces': 0::BIGINT, 'sq': 0::BIGINT, 'l': 0::BIGINT}}] AS best
  FROM runs LEFT JOIN lattice USING (run)
  UNION ALL
  SELECT run, n, edges, pos - 1, list_prepend(list_sort(list_append(
           list_transform(list_filter(edges, lambda e: e.i = pos - 1),
             lambda e: {{'loose': best[e.l].loose, 'pieces': best[e.l].pieces + 1, 'sq': best[e.l].sq - e.l * e.l, 'l': -e.l}}),
           {{'loose': best[1].loose + 1, 'pieces': best[1].pieces + 1, 'sq': best[1].sq - 1, 'l': (-1)::BIGINT}}))[1], best)
  FROM dp WHERE pos > 1
),
walk AS (
  SELECT run, n, best, 1::BIGINT AS pos, substr(run, 1, -best[1].l) AS keyword FROM dp WHERE pos = 1
  UNION ALL
  SELECT run, n, best, pos - best[pos].l, substr(run, pos - best[pos].l, -best[pos - best[pos].l].l)
  FROM walk WHERE pos - best[pos].l <= length(run)
)
SELECT keyword, CAST(sum(n) AS BIGINT) AS keyword_count FROM walk GROUP BY keyword
""")

register("sensitive_word_flag", f"""
WITH w AS (SELECT DISTINCT unnest({TOKENS}) AS word FROM documents),
l AS (SELECT * FROM (VALUES ('password'), ('secret'), ('token'), ('apikey'), ('passwd'), ('private'),
                             ('ssn'), ('license')) AS t(lw))
SELECT word, lw IS NOT NULL AS listed FROM w LEFT JOIN l ON word = lw
""")


def _charset_sql() -> str:
    from ..functions.strings import CHARSET_PATTERN
    pat = CHARSET_PATTERN.replace("'", "''")
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\r\f]+') AS toks FROM documents)
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(toks, lambda x: regexp_matches(x, '{pat}'))) AS BIGINT) AS n_clean
FROM d
"""


register("text_charset_filter", _charset_sql())

register("page_titles", """
WITH x AS (
  SELECT page_id, regexp_extract_all(html, '<(?:title|h1|a)(?: [^>]*)?>([^<]*)</(?:title|h1|a)>', 1) AS items
  FROM pages
),
y AS (SELECT page_id, unnest(generate_series(0, len(items) - 1)) AS pos, unnest(items) AS title FROM x)
SELECT page_id, CAST(pos AS INTEGER) AS pos, title FROM y WHERE NOT contains(title, '/')
""")


# -- log split -------------------------------------------------------------------

LOGS = f"""
{PAGE_LOG},
ev AS (
  SELECT p.*, e.event_type, e.value, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         's_' || CAST(p.event_id AS VARCHAR) AS sid
  FROM page_log p JOIN events e USING (event_id)
),
logs AS (
  SELECT *, (event_type = 'signup' OR (event_type = 'error' AND k % 2 = 0)) AS is_start,
         (event_type = 'error' AND value < 1.0) AS dirty
  FROM ev
),
rep AS (
  SELECT *, first_value(is_new) OVER w AS ff, first_value(ts_ms) OVER w AS fts
  FROM logs WHERE NOT dirty
  WINDOW w AS (PARTITION BY mid ORDER BY ts_ms, sid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
fixed AS (
  SELECT * REPLACE (
    CASE WHEN is_new = '1' AND
              (CASE WHEN ff = '1' THEN strftime(epoch_ms(fts), '%Y-%m-%d')
                    ELSE strftime(CAST(epoch_ms(fts) AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') END)
              <> strftime(epoch_ms(ts_ms), '%Y-%m-%d')
         THEN '0' ELSE is_new END AS is_new)
  FROM rep
)"""

register("log_split_page", f"""
WITH {LOGS}
SELECT sid, mid, uid, is_new, page_id, last_page_id, item, during_time, ts_ms AS ts FROM fixed WHERE NOT is_start
""")
register("log_split_start", f"""
WITH {LOGS}
SELECT sid, mid, is_new, 'icon' AS entry, during_time AS loading_time, ts_ms AS ts FROM fixed WHERE is_start
""")
register("log_split_err", f"""
WITH {LOGS}
SELECT sid, mid, is_new, CAST(k AS BIGINT) AS error_code, 'exception at ' || page_id AS msg,
       is_start AS has_start, ts_ms AS ts
FROM fixed WHERE event_type = 'error'
""")
register("log_split_display", f"""
WITH {LOGS},
d AS (SELECT sid, mid, page_id, k, ts_ms, unnest(generate_series(0, k % 4 - 1)) AS i
      FROM fixed WHERE event_type = 'view' AND NOT is_start)
SELECT sid, mid, page_id, CAST(k + i AS VARCHAR) AS item, 'sku_id' AS item_type,
       CAST(i + 1 AS INTEGER) AS pos_id, CAST(i AS INTEGER) AS pos_seq, ts_ms AS ts
FROM d
""")
register("log_split_action", f"""
WITH {LOGS},
a AS (SELECT sid, mid, page_id, k, ts_ms, unnest(generate_series(0, k % 3)) AS i
      FROM fixed WHERE event_type = 'click' AND NOT is_start)
SELECT sid, mid, page_id, CASE WHEN i = 0 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST(k AS VARCHAR) AS item, ts_ms + i * 1000 AS action_ts
FROM a
""")
register("log_split_dirty", f"""
WITH {LOGS}
SELECT sid FROM logs WHERE dirty
""")


# -- routing ------------------------------------------------------------------------

T0 = 1_700_000_000_000

def kv(*pairs: tuple[str, str]) -> str:
    """DuckDB list of {k, v} structs (one entry per image column)."""
    return "[" + ", ".join("{'k': '%s', 'v': %s}" % (k, v) for k, v in pairs) + "]"


USER_CHANGES = f"""
cust AS (
  SELECT {vc('c_custkey')} AS id, c_name, {vc('c_nationkey')} AS nation_id, c_mktsegment,
         {vc(d2('c_acctbal'))} AS bal_txt, c_acctbal
  FROM customer
),
uc AS (
  SELECT 'r' AS op, {T0} AS ts, id, {kv(('id', 'id'), ('name', 'c_name'), ('nation_id', 'nation_id'), ('segment', 'c_mktsegment'), ('acctbal', 'bal_txt'))} AS kv FROM cust
  UNION ALL
  SELECT 'u', {T0 + 1000}, id, {kv(('id', 'id'), ('name', "c_name || '-v2'"), ('nation_id', 'nation_id'), ('segment', "''"), ('acctbal', 'CAST(NULL AS VARCHAR)'))} FROM cust WHERE c_acctbal < 0
  UNION ALL
  SELECT 'd', {T0 + 2000}, id, {kv(('id', 'id'), ('name', 'c_name'), ('nation_id', 'nation_id'), ('segment', 'c_mktsegment'), ('acctbal', 'bal_txt'))} FROM cust WHERE c_acctbal > 9000
  UNION ALL
  SELECT 'c', {T0 + 3000}, id, {kv(('id', 'id'), ('name', "c_name || '-back'"), ('nation_id', 'nation_id'), ('segment', 'CAST(NULL AS VARCHAR)'), ('acctbal', "'0.00'"))} FROM cust WHERE c_acctbal > 9500
)"""

_NONEMPTY = "op <> 'd' AND v IS NOT NULL AND v <> ''"


def _fold_col(c: str) -> str:
    return (f"arg_max(v, ts) FILTER (WHERE {_NONEMPTY} AND k = '{c}') AS {c}, "
            f"max(ts) FILTER (WHERE {_NONEMPTY} AND k = '{c}') AS {c}_ts")


register("dim_fold", f"""
WITH {USER_CHANGES},
cells AS (SELECT op, ts, id, unnest(kv, recursive := true) FROM uc),
keys_ AS (SELECT id, max(ts) FILTER (WHERE op = 'd') AS del, max(ts) AS last FROM uc GROUP BY id),
c AS (SELECT id, {_fold_col('name')}, {_fold_col('nation_id')}, {_fold_col('segment')}, {_fold_col('acctbal')}
      FROM cells GROUP BY id)
SELECT keys_.id,
       CASE WHEN del IS NULL OR name_ts > del THEN name END AS name,
       CASE WHEN del IS NULL OR nation_id_ts > del THEN nation_id END AS nation_id,
       CASE WHEN del IS NULL OR segment_ts > del THEN segment END AS segment,
       CASE WHEN del IS NULL OR acctbal_ts > del THEN acctbal END AS acctbal
FROM keys_ JOIN c USING (id) WHERE del IS NULL OR last > del
""")

register("dim_route", f"""
WITH {USER_CHANGES},
ch AS (
  SELECT 'user_info' AS src, op, ts, id AS rk, kv FROM uc
  UNION ALL
  SELECT 'sku_info', 'r', {T0}, {vc('p_partkey')}, {kv(('id', vc('p_partkey')), ('sku_name', 'p_name'), ('brand', 'p_brand'), ('type', 'p_type'), ('size', vc('p_size')))} FROM part
  UNION ALL
  SELECT 'base_province', 'r', {T0}, {vc('n_nationkey')}, {kv(('id', vc('n_nationkey')), ('name', 'n_name'), ('region_id', vc('n_regionkey')))} FROM nation
  UNION ALL
  SELECT 'base_region', 'r', {T0}, {vc('r_regionkey')}, {kv(('id', vc('r_regionkey')), ('name', 'r_name'))} FROM region
),
cfg_feed AS (
  SELECT * FROM (VALUES
    ('r', 1, 'user_info', 'dim_user_info', 'id,name,nation_id,segment'),
    ('r', 1, 'sku_info', 'dim_sku_info', 'id,sku_name,brand,type,size'),
    ('r', 1, 'base_province', 'dim_base_province', 'id,name,region_id'),
    ('r', 1, 'base_region', 'dim_base_region', 'id,name'),
    ('u', {T0 + 500}, 'user_info', 'dim_user_info', 'id,name,segment'),
    ('d', 3, 'base_region', 'dim_base_region', 'id,name')) AS f(op, ts, source_table, sink_table, sink_columns)
),
cfg AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY ts DESC) AS rn FROM cfg_feed)
  WHERE rn = 1 AND op <> 'd'
),
routed AS (
  SELECT sink_table, ch.op, ch.ts, rk,
         list_filter(kv, lambda e: list_contains(string_split(sink_columns, ','), e.k)) AS kv
  FROM ch JOIN cfg ON ch.src = cfg.source_table
  WHERE cfg.op <> 'u' OR ch.ts >= cfg.ts
),
cells AS (SELECT sink_table, rk, op, ts, unnest(kv, recursive := true) FROM routed),
rows_ AS (SELECT sink_table, rk, max(ts) FILTER (WHERE op = 'd') AS del, max(ts) AS last FROM routed GROUP BY 1, 2),
c AS (
  SELECT sink_table, rk, k AS col, arg_max(v, ts) AS value, max(ts) AS cts
  FROM cells WHERE {_NONEMPTY} GROUP BY 1, 2, 3
)
SELECT c.sink_table, c.rk AS row_key, col AS "column", value
FROM c JOIN rows_ USING (sink_table, rk)
WHERE (del IS NULL OR last > del) AND (del IS NULL OR cts > del)
""")

register("fact_route", f"""
WITH ev AS (
  SELECT event_id, user_id, ts, props, event_type FROM events WHERE event_type IN ('purchase', 'view')
),
cart AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'c' ELSE 'u' END AS op, {vc('event_id')} AS id,
         [('id', {vc('event_id')}), ('user_id', {vc('user_id')}), ('sku_id', json_extract_string(props, '$.k')),
          ('sku_num', {vc('event_id % 7 + 1')}), ('ts_ms', {vc(ms('ts'))})] AS kv
  FROM ev WHERE event_type = 'purchase'
),
routed AS (
  SELECT 'dwd_cart_add' AS sink_table, id, list_filter(kv, lambda e: e[1] IN ('id', 'user_id', 'sku_id', 'sku_num', 'ts_ms')) AS kv,
         CAST(id AS BIGINT) % 10 = 0 AS again
  FROM cart WHERE op = 'c'
  UNION ALL
  SELECT 'dwd_cart_update', id, list_filter(kv, lambda e: e[1] IN ('id', 'sku_num', 'ts_ms')), CAST(id AS BIGINT) % 10 = 0
  FROM cart WHERE op = 'u'
  UNION ALL
  SELECT 'dwd_comment', {vc('event_id')},
         [('id', {vc('event_id')}), ('user_id', {vc('user_id')}), ('appraise', {vc('1201 + event_id % 4')}),
          ('comment_txt', 'comment ' || {vc('event_id')}), ('ts_ms', {vc(ms('ts'))})], event_id % 8 = 0
  FROM ev WHERE event_type = 'view'
  UNION ALL
  SELECT 'dwd_refund_payment_success', {vc('o_orderkey')},
         [('id', {vc('o_orderkey')}), ('order_id', {vc('o_orderkey')}), ('payment_type', {vc('1101 + o_orderkey % 3')}),
          ('refund_status', '1602'), ('ts_ms', {vc(ms('o_orderdate') + ' + (o_orderkey % 60 - 10) * 60000')})],
         o_orderkey % 7 = 0
  FROM orders WHERE o_orderstatus = 'F'
)
SELECT sink_table, id AS row_id, e[1] AS "column", e[2] AS value
FROM (SELECT sink_table, id, unnest(kv) AS e FROM routed, range(2) AS r(k) WHERE k = 0 OR again)
""")


# -- re-aimed utilities, scalar functions ------------------------------------------

register("day_partition_spine", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
spine AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS day_ts FROM d),
c AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day, count(*) AS n FROM d GROUP BY 1)
SELECT CAST(strftime(day_ts, '%Y%m%d') AS INTEGER) AS day, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM spine LEFT JOIN c ON CAST(strftime(day_ts, '%Y%m%d') AS INTEGER) = c.day
""")

register("event_day_partition", f"""
WITH v AS (
  SELECT CASE WHEN event_type = 'view' THEN CAST({ms('ts')} // 1000 AS VARCHAR)
              WHEN event_type = 'error' THEN 'n/a' ELSE CAST({ms('ts')} AS VARCHAR) END AS v FROM events
),
n AS (SELECT TRY_CAST(v AS BIGINT) AS n FROM v),
m AS (SELECT CASE WHEN n < 10000000000 THEN n * 1000 ELSE n END AS ms FROM n)
SELECT coalesce(strftime(epoch_ms(ms), '%Y%m%d'), 'error_bucket') AS day, CAST(count(*) AS BIGINT) AS n
FROM m GROUP BY 1
""")

register("salted_key_buckets", """
SELECT lpad(CAST(CAST(('0x' || right(md5(CAST(c_custkey AS VARCHAR)), 3)) AS INTEGER) % 128 AS VARCHAR), 4, '0') AS bucket,
       CAST(count(*) AS BIGINT) AS n
FROM customer GROUP BY 1
""")

register("salted_key_buckets_hot", """
SELECT CASE o_custkey WHEN 1 THEN 'hot1' WHEN 7 THEN 'hot7' WHEN 42 THEN 'hot42' ELSE
         lpad(CAST(CAST(('0x' || right(md5(CAST(o_custkey AS VARCHAR)), 3)) AS INTEGER) % 128 AS VARCHAR), 4, '0') END AS bucket,
       CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1
""")

register("ordered_list_append", """
SELECT conv_id, string_agg(role, ',' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id
""")

register("scan_limit", """
SELECT p_partkey, p_name, p_brand, CAST(p_partkey AS VARCHAR) AS row_key FROM part ORDER BY p_partkey LIMIT 100
""")

register("table_row_count", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {t}" for t in
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()))

register("scalar_dates", f"""
WITH e AS (SELECT event_id, {ms('ts')} AS ms FROM events)
SELECT event_id, ms,
       strftime(epoch_ms(ms), '%Y-%m-%d') AS date,
       strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') AS datetime,
       strftime(epoch_ms(ms), '%Y%m%d') AS day,
       strftime(epoch_ms(ms), '%Y/%m/%d %H') AS hour_text,
       ms // 1000 * 1000 AS second_ms,
       epoch_ms(CAST(epoch_ms(ms) AS DATE)::TIMESTAMP) AS midnight_ms,
       CAST(date_diff('day', DATE '2024-01-01', CAST(epoch_ms(ms) AS DATE)) AS INTEGER) AS day_no,
       strftime(CAST(epoch_ms(ms) AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_date,
       strftime(epoch_ms(ms), '%Y-%m-%d') AS date_from_text
FROM e
""")

register("scalar_strings", """
SELECT p_partkey,
       p_brand || ',' || p_type AS brand_type,
       upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS name_cap,
       lower(substr(upper(p_name), 1, 1)) || substr(upper(p_name), 2) AS name_low,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_pad,
       repeat('*', CAST(p_size % 5 AS INTEGER)) AS stars,
       coalesce(trim(CASE WHEN p_size % 7 = 0 THEN '  ' ELSE p_name END), '') = '' AS blank,
       (CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END) IS NULL OR (CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END) = '' AS empty
FROM part
""")

register("scalar_rowkey", """
SELECT p_partkey,
       CAST(p_partkey AS VARCHAR) || '_' || p_brand || '_' || p_type AS rk,
       md5(CAST(p_partkey AS VARCHAR)) || '|' || md5(p_brand) || '|' || md5(p_type) AS rk_md5_fields,
       md5(CAST(p_partkey AS VARCHAR) || '_' || p_brand || '_' || p_type) AS rk_md5
FROM part
""")


# -- watermarks over recorded arrivals, event time from other fields, topics re-read ----

ARRIVALS = f"""{PAGE_LOG},
arrivals AS (
  SELECT *, ts_ms + (event_id * 37) % 6001
         + CASE WHEN event_id % 97 = 0 THEN 10800000 WHEN event_id % 10 = 3 THEN (event_id * 7919) % 1200001 ELSE 0 END AS arrival_ms
  FROM page_log
)"""


def _met(lag_ms: int) -> str:
    """Each row with the watermark of all rows of earlier steps (the literal way)."""
    return f"""
met AS (
  SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms // 10000 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {lag_ms} AS watermark
  FROM arrivals
),
judged AS (
  SELECT *, coalesce((ts_ms // 10000 + 1) * 10000 <= watermark, false) AS late FROM met
)"""


def _page_counts(rows: str, time: str = "ts_ms") -> str:
    return f"""
SELECT {win_cols(f"min({time})", 10_000)}, vc, ch, ar, is_new,
       count(*) FILTER (last_page_id IS NULL OR last_page_id = '') AS sv_ct, count(*) AS pv_ct,
       CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM {rows} GROUP BY {win_key(time, 10_000)}, vc, ch, ar, is_new"""


register("page_late_rows", f"""
WITH {ARRIVALS}, {_met(3_000)}
SELECT event_id, mid, page_id, ts_ms, arrival_ms, watermark FROM judged WHERE late
""")

register("page_on_time_window", f"WITH {ARRIVALS}, {_met(3_000)} {_page_counts('judged WHERE NOT late')}")
register("page_on_time_window_monotonous", f"WITH {ARRIVALS}, {_met(0)} {_page_counts('judged WHERE NOT late')}")
register("page_arrival_window", f"WITH {ARRIVALS} {_page_counts('arrivals', 'arrival_ms')}")

register("event_time_fallback", """
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN epoch_ms(o_orderdate) // 1000
                          WHEN o_orderkey % 11 <> 0 THEN epoch_ms(o_orderdate) // 1000 + 3600 END AS sec
  FROM orders
)
SELECT o_orderkey, sec * 1000 AS et_ms, strftime(epoch_ms(sec * 1000), '%Y-%m-%d %H:%M:%S') AS et FROM s
""")

register("batch_event_time", f"""
WITH {PAGE_LOG}
SELECT event_id // 16 AS batch_id, arg_min(ts_ms, event_id) AS et_ms, count(*) AS n,
       CAST(sum(coalesce(during_time, 0)) AS BIGINT) AS during_time
FROM page_log GROUP BY 1
""")

register("page_topic_rows", f"""
WITH {PAGE_LOG}
SELECT mid, uid, vc, ch, ar, is_new, 's-' || CAST(event_id AS VARCHAR) AS sid, page_id, last_page_id, item, item_type,
       during_time, ts_ms
FROM page_log WHERE event_id % 53 <> 0
""")

register("page_topic_dirty", f"""
WITH {PAGE_LOG}
SELECT substr('{{"common":{{"mid":"' || mid || '",' || coalesce('"uid":"' || uid || '",', '') || '"vc":"' || vc || '"', 1, 30) AS value
FROM page_log WHERE event_id % 53 = 0
""")

register("order_detail_topic_rows", f"""
WITH {ORDER_DETAIL}
SELECT * EXCLUDE (create_ms), strftime(epoch_ms(ts_ms), '%Y-%m-%d %H:%M:%S') AS et FROM detail
""")

register("camel_case_columns", """
SELECT c_custkey AS "cCustkey", c_name AS "cName", c_mktsegment AS "cMktsegment" FROM customer
""")
