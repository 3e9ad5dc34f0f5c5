"""Retail inputs derived from the TPC-H-like tables.

The warehouse consumes two feeds -- application page logs and database change
records -- plus a handful of dimension tables. Here they are derived, lazily
and row for row, from the given tables so that every job's work grows with
the data (see FIXTURES.md section 4 for the exact derivations). Nothing is
collected; each function returns a plain DataFrame plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_ms
from .cdc import change_records, envelope, explode_envelopes, replayed, text_map
from .tables import Tables, ts_col


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --------------------------------------------------------------------------
# page log (DWD page topic)
# --------------------------------------------------------------------------

def page_log(t: Tables, extra=()) -> DataFrame:
    """Flat page-log rows: one per event.

    Columns: event_id, ts (TIMESTAMP), ts_ms, mid, uid, vc, ch, ar, is_new,
    page_id, last_page_id, item, item_type, during_time (+ ``extra`` event
    columns passed through).
    Search pages (``last_page_id = 'search'``) carry a keyword reference:
    ``item`` is the id of the document holding the search text.
    """
    e = t.events
    uid = e.user_id
    et = e.event_type
    return e.select(
        e.event_id,
        ts_col("ts").alias("ts"),
        epoch_ms("ts").alias("ts_ms"),
        F.concat(F.lit("mid_"), _s(uid)).alias("mid"),
        F.when(e.event_id % 7 == 0, F.lit(None).cast("string")).otherwise(_s(uid)).alias("uid"),
        F.concat(F.lit("v2.1."), _s(uid % 3)).alias("vc"),
        F.when(uid % 3 == 0, "appstore").when(uid % 3 == 1, "xiaomi").otherwise("oppo").alias("ch"),
        _s(uid % 5).alias("ar"),
        F.when(e.event_id % 3 == 0, "0").otherwise("1").alias("is_new"),
        F.when(et == "view", "home").when(et == "click", "good_detail")
         .when(et == "purchase", "payment").when(et == "signup", "login")
         .otherwise("mine").alias("page_id"),
        F.when(et == "signup", F.when(e.event_id % 2 == 0, F.lit(None)).otherwise(F.lit("login")))
         .when(et == "click", "search").otherwise("home").alias("last_page_id"),
        F.when(et == "click", _s(uid)).alias("item"),
        F.when(et == "click", F.lit("keyword")).alias("item_type"),
        F.round(e.value * 1000).cast("bigint").alias("during_time"),
        *[e[c] for c in extra],
    )


def page_arrivals(t: Tables) -> DataFrame:
    """The page log with the time each row reached the server (``arrival_ms``):
    up to 6 s after the view; a view in 10 was kept by its phone for up to
    twenty minutes more, one in 97 for three hours."""
    p = page_log(t)
    e = F.col("event_id")
    delay = (e * 37) % 6_001 + F.when(e % 97 == 0, F.lit(10_800_000)).when(e % 10 == 3, (e * 7919) % 1_200_001).otherwise(F.lit(0))
    return p.withColumn("arrival_ms", F.col("ts_ms") + delay)


def page_topic(t: Tables) -> DataFrame:
    """The page topic as text (``value``): one JSON object per page-log row;
    rows of events divisible by 53 arrive cut off (dirty)."""
    p = page_log(t)
    common = F.struct("mid", "uid", "vc", "ch", "ar", "is_new", F.concat(F.lit("s-"), _s("event_id")).alias("sid"))
    page = F.struct("page_id", "last_page_id", "item", "item_type", "during_time")
    line = F.to_json(F.struct(common.alias("common"), page.alias("page"), F.col("ts_ms").alias("ts")))
    cut = F.when(F.col("event_id") % 53 == 0, F.substring(line, 1, 30)).otherwise(line)
    return p.select(cut.alias("value"))


# --------------------------------------------------------------------------
# change feed of the shop database (ODS topic)
# --------------------------------------------------------------------------

MINUTE_MS = 60_000


def _dec(c, p: int = 16, s: int = 2) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({p},{s})")


def order_status(code) -> F.Column:
    """Order states of the shop: P -> 1001 (placed), F -> 1003 (cancelled),
    O -> 1005 (refunding)."""
    c = F.col(code)
    return F.when(c == "P", "1001").when(c == "F", "1003").when(c == "O", "1005")


def order_info_feed(t: Tables) -> DataFrame:
    """order_info changes: an insert per order (status 1001) and, for orders
    that moved on, an update 1001 -> 1003 (F, 10 min later) or
    1001 -> 1005 (O, 20 min later). Replays: orders divisible by 13 are
    inserted again a minute later with another province, updates of orders
    divisible by 9 come twice."""
    o = t.orders.join(t.customer.select("c_custkey", "c_nationkey"),
                      F.col("o_custkey") == F.col("c_custkey"), "inner")
    created = epoch_ms("o_orderdate")
    delay = F.when(F.col("o_orderstatus") == "F", 10 * MINUTE_MS).otherwise(20 * MINUTE_MS)
    row = lambda status, op_time, province="c_nationkey": text_map({
        "id": "o_orderkey", "user_id": "o_custkey", "province_id": province,
        "order_status": status, "create_time": created, "operate_time": op_time,
        "total_amount": _dec("o_totalprice")})
    # inserts and updates apart, so that a job that reads one op builds no other
    again = F.col("__copy") == 1
    moved = F.when(again, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    inserts = change_records(replayed(o, F.col("o_orderkey") % 13 == 0), "order_info", "c", row(F.lit("1001"), None, moved), None,
                             created + F.when(again, MINUTE_MS).otherwise(0))
    updates = change_records(replayed(o.where(F.col("o_orderstatus").isin("F", "O")), F.col("o_orderkey") % 9 == 0), "order_info", "u",
                             row(order_status("o_orderstatus"), created + delay), row(F.lit("1001"), None), created + delay)
    return inserts.unionByName(updates)


def _lines(t: Tables) -> DataFrame:
    """lineitem with the part's name/price and its order's time. The order comes
    last and by its text (``order_id``), as records carry it: lines are then dealt
    out by it, and a job that joins them to their orders moves none of them again."""
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    o = t.orders.select(_s("o_orderkey").alias("__order"), "o_orderdate")
    li = t.lineitem.join(p, F.col("l_partkey") == F.col("p_partkey"), "left") \
        .select(_s("l_orderkey").alias("order_id"), line_time_ms().alias("__ms"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "p_name", "p_retailprice")
    return li.join(o, F.col("order_id") == F.col("__order"), "inner")


def detail_id(order: str = "l_orderkey") -> F.Column:
    return F.concat(_s(order), F.lit("-"), _s("l_linenumber"))


def line_time_ms() -> F.Column:
    """Change time of a line: its ship date, at a second given by its order."""
    return epoch_ms("l_shipdate") + (F.col("l_orderkey") % 60) * 1000


def order_detail_feed(t: Tables) -> DataFrame:
    """order_detail inserts, one per lineitem row. (orderkey, linenumber)
    repeats on purpose: a repeated id is a replayed record. Lines of parts
    divisible by 17 are replayed exactly."""
    li = _lines(t)
    original = _dec("l_extendedprice")
    activity = original * _dec("l_discount")
    coupon = original * _dec("l_tax")
    # the texts of a line are made once, ahead of the repeat
    texts = {"id": detail_id("order_id"), "order_id": "order_id", "sku_id": "l_partkey", "sku_name": "p_name",
             "create_time": epoch_ms("o_orderdate"), "source_id": "l_suppkey", "source_type": F.lit("2401"),
             "sku_num": _dec("l_quantity"), "order_price": _dec("p_retailprice"),
             "split_original_amount": original,
             "split_activity_amount": activity, "split_coupon_amount": coupon,
             "split_total_amount": original - activity - coupon}
    lines = li.select((F.col("l_partkey") % 17 == 0).alias("__again"), "__ms", *[_s(c).alias(k) for k, c in texts.items()])
    return change_records(replayed(lines, F.col("__again")), "order_detail", "c", text_map({k: k for k in texts}), None, F.col("__ms"))


def order_detail_activity_feed(t: Tables) -> DataFrame:
    """Activity attached to a detail line, once for each version of the line
    with discount >= 0.05; the rule differs between versions."""
    li = t.lineitem.where(F.col("l_discount") >= 0.05)
    after = text_map({"order_detail_id": detail_id(), "activity_id": F.col("l_linenumber") + 100,
                      "activity_rule_id": F.col("l_linenumber") * 10 + F.col("l_suppkey") % 3})
    return change_records(li, "order_detail_activity", "c", after, None, line_time_ms(), pos=F.col("l_suppkey"))


def order_detail_coupon_feed(t: Tables) -> DataFrame:
    """Coupon attached to a detail line, once for each version of the line
    with tax >= 0.05."""
    li = t.lineitem.where(F.col("l_tax") >= 0.05)
    after = text_map({"order_detail_id": detail_id(), "coupon_id": F.col("l_linenumber") + 200})
    return change_records(li, "order_detail_coupon", "c", after, None, line_time_ms())


def cart_info_feed(t: Tables) -> DataFrame:
    """cart_info changes from purchase events: even ids insert, odd ids update
    an existing cart line (old quantity missing for some updates); ids
    divisible by 10 are replayed."""
    e = t.events.where(F.col("event_type") == "purchase")
    is_c = e.event_id % 2 == 0
    old = F.when(is_c | (e.event_id % 11 == 0), F.lit(None)).otherwise(_s(e.event_id % 5))
    new = _s(e.event_id % 7 + 1)
    sku = F.get_json_object("props", "$.k")
    row = lambda n: text_map({"id": "event_id", "user_id": "user_id", "sku_id": sku, "sku_num": n})
    return change_records(replayed(e, F.col("event_id") % 10 == 0), "cart_info", F.when(is_c, "c").otherwise("u"), row(new),
                          F.when(is_c, None).otherwise(row(old)), epoch_ms("ts"))


def payment_time_ms() -> F.Column:
    """Payment callback time: order date shifted by (orderkey % 60 - 10) minutes."""
    return epoch_ms("o_orderdate") + ((F.col("o_orderkey") % 60) - 10) * MINUTE_MS


def refund_payment_feed(t: Tables) -> DataFrame:
    """refund_payment status updates 1601 -> 1602 for the cancelled orders;
    those of orders divisible by 7 come twice."""
    o = t.orders.where(F.col("o_orderstatus") == "F")
    et = payment_time_ms()
    row = lambda st: text_map({
        "id": "o_orderkey", "order_id": "o_orderkey",
        "payment_type": F.lit(1101) + F.col("o_orderkey") % 3,
        "callback_time": et, "total_amount": _dec("o_totalprice"), "refund_status": st})
    return change_records(replayed(o, F.col("o_orderkey") % 7 == 0), "refund_payment", "u", row(F.lit("1602")), row(F.lit("1601")), et)


def order_refund_info_feed(t: Tables) -> DataFrame:
    """order_refund_info snapshot rows: one per detail id with return flag R;
    those of orders divisible by 5 come twice."""
    li = (t.lineitem.where(F.col("l_returnflag") == "R")
          .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
          .groupBy("l_orderkey", "l_linenumber")
          .agg(F.min("o_custkey").alias("o_custkey"), F.min("l_partkey").alias("l_partkey"),
               F.sum("l_quantity").alias("l_quantity"), F.max("l_extendedprice").alias("l_extendedprice"),
               F.max("l_shipdate").alias("l_shipdate")))
    created = epoch_ms("l_shipdate")
    after = text_map({
        "id": detail_id(), "user_id": "o_custkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
        "refund_type": F.lit(1501) + F.col("l_linenumber") % 2,
        "refund_num": F.col("l_quantity").cast("bigint"),
        "refund_amount": _dec("l_extendedprice"),
        "refund_reason_type": F.lit(1301) + F.col("l_partkey") % 3,
        "refund_reason_txt": F.concat(F.lit("reason for line "), detail_id()),
        "create_time": created, "refund_status": F.lit("0701")})
    return change_records(replayed(li, F.col("l_orderkey") % 5 == 0), "order_refund_info", "r", after, None, created)


def comment_info_feed(t: Tables) -> DataFrame:
    """comment_info snapshot rows from view events; appraise 1201..1204; ids
    divisible by 8 come twice."""
    e = t.events.where(F.col("event_type") == "view")
    after = text_map({"id": "event_id", "user_id": "user_id", "sku_id": F.get_json_object("props", "$.k"),
                      "appraise": F.lit(1201) + F.col("event_id") % 4,
                      "comment_txt": F.concat(F.lit("comment "), _s("event_id")),
                      "create_time": epoch_ms("ts")})
    return change_records(replayed(e, F.col("event_id") % 8 == 0), "comment_info", "r", after, None, epoch_ms("ts"))


FEEDS = {
    "order_info": order_info_feed,
    "order_detail": order_detail_feed,
    "order_detail_activity": order_detail_activity_feed,
    "order_detail_coupon": order_detail_coupon_feed,
    "cart_info": cart_info_feed,
    "refund_payment": refund_payment_feed,
    "order_refund_info": order_refund_info_feed,
    "comment_info": comment_info_feed,
}


def ods(t: Tables, tables=None) -> DataFrame:
    """The whole change feed (all source tables in one DataFrame, like the
    single ODS topic). ``tables`` restricts it to the source tables a job
    reads -- the same as the job's ``source.table`` filter, applied at the
    source so unrelated tables are never scanned."""
    names = list(FEEDS) if tables is None else list(tables)
    out = None
    for n in names:
        d = FEEDS[n](t)
        out = d if out is None else out.unionByName(d)
    return out


# --------------------------------------------------------------------------
# dimensions and dictionary
# --------------------------------------------------------------------------

# The dictionary (dic_code, dic_name, parent_code) of payment
# types, appraisals, refund types and refund reasons. Appraisal 1204 is
# deliberately absent, so the inner dictionary lookup drops those comments.
BASE_DIC = [
    ("1101", "alipay", "11"), ("1102", "wechat", "11"), ("1103", "unionpay", "11"),
    ("1201", "good", "12"), ("1202", "medium", "12"), ("1203", "bad", "12"),
    ("1301", "quality issue", "13"), ("1302", "wrong size", "13"), ("1303", "other reason", "13"),
    ("1501", "refund only", "15"), ("1502", "return and refund", "15"),
]


def base_dic(spark) -> DataFrame:
    """Dictionary lookup table as stored: row key ``dic_code`` and a column
    family ``info`` holding ``dic_name`` (S10)."""
    dic = spark.createDataFrame(BASE_DIC, "dic_code string, dic_name string, parent_code string")
    return F.broadcast(dic).select("dic_code", F.struct("dic_name", "parent_code").alias("info"))


def base_dic_feed(t: Tables) -> DataFrame:
    """The dictionary's own changes: each quarter that has orders renames every
    code (``name@yyyyQq``) at the quarter's first order, and deletes the unions'
    codes (ending in 3) instead in third quarters; codes ending in 2 only come
    with the second quarter that has any."""
    o = t.orders.select(F.date_trunc("quarter", "o_orderdate").alias("q"), epoch_ms("o_orderdate").alias("at")) \
        .groupBy("q").agg(F.min("at").alias("at"))
    first = t.orders.agg(F.min(epoch_ms("o_orderdate")).alias("first"))
    codes = F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("name")) for c, n, _ in BASE_DIC])).alias("d")
    q = o.select("q", "at", codes).withColumn("no", F.quarter("q"))
    row = text_map({"dic_code": F.col("d.code"), "dic_name": F.concat(F.col("d.name"), F.lit("@"), F.year("q").cast("string"), F.lit("Q"), F.col("no").cast("string"))})
    gone = (F.col("no") == 3) & F.col("d.code").endswith("3")
    late = F.col("d.code").endswith("2") & (F.col("at") == first.scalar())
    rec = F.when(gone, envelope("base_dic", "d", None, row, F.col("at"))).when(~late, envelope("base_dic", "u", row, None, F.col("at")))
    return explode_envelopes(q, [rec], "base_dic")


def province_dim(t: Tables) -> DataFrame:
    """dim_base_province: id, name (from nation)."""
    return t.nation.select(_s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                           _s("n_regionkey").alias("region_id"))


def sku_dims(t: Tables) -> dict[str, DataFrame]:
    """The SKU snowflake: sku -> spu -> trademark, sku -> category3 ->
    category2 -> category1, derived from part / region. spu = part name,
    trademark = brand, category3 = type, category2 = size band, category1 =
    region of the size band."""
    p = t.part
    sku = p.select(_s("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                   F.col("p_name").alias("spu_id"), F.col("p_type").alias("category3_id"),
                   F.col("p_brand").alias("tm_id"))
    spu = p.select(F.col("p_name").alias("id"), F.col("p_name").alias("spu_name")).distinct()
    tm = p.select(F.col("p_brand").alias("id"), F.col("p_brand").alias("tm_name")).distinct()
    c3 = p.select(F.col("p_type").alias("id"), F.lower("p_type").alias("name"),
                  F.concat(F.lit("size"), _s(F.col("p_size") % 5)).alias("category2_id")) \
          .groupBy("id", "name").agg(F.min("category2_id").alias("category2_id"))
    r = t.region
    c2 = (r.select(F.concat(F.lit("size"), _s("r_regionkey")).alias("id"),
                   F.concat(F.lit("size band "), _s("r_regionkey")).alias("name"),
                   _s("r_regionkey").alias("category1_id")))
    c1 = r.select(_s("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return {"sku": sku, "spu": spu, "trademark": tm, "category3": c3, "category2": c2, "category1": c1}


# --------------------------------------------------------------------------
# dimension change feeds (DIM layer input)
# --------------------------------------------------------------------------

DIM_T0 = 1_700_000_000_000


def user_info_feed(t: Tables) -> DataFrame:
    """user_info changes from customer: a snapshot row each; negative
    balances later rename the user and send empty segment / null balance
    (cells that must not overwrite); balances above 9000 are deleted, and
    above 9500 inserted again with fresh values."""
    c = t.customer
    full = text_map({"id": "c_custkey", "name": "c_name", "nation_id": "c_nationkey",
                     "segment": "c_mktsegment", "acctbal": _dec("c_acctbal")})
    upd = text_map({"id": "c_custkey", "name": F.concat(F.col("c_name"), F.lit("-v2")),
                    "nation_id": "c_nationkey", "segment": F.lit(""), "acctbal": None})
    back = text_map({"id": "c_custkey", "name": F.concat(F.col("c_name"), F.lit("-back")),
                     "nation_id": "c_nationkey", "segment": None, "acctbal": F.lit("0.00")})
    bal = F.col("c_acctbal")
    recs = [
        envelope("user_info", "r", full, None, F.lit(DIM_T0)),
        F.when(bal < 0, envelope("user_info", "u", upd, full, F.lit(DIM_T0 + 1000))),
        F.when(bal > 9000, envelope("user_info", "d", None, full, F.lit(DIM_T0 + 2000))),
        F.when(bal > 9500, envelope("user_info", "c", back, None, F.lit(DIM_T0 + 3000))),
    ]
    return explode_envelopes(c, recs, "user_info")


def sku_info_feed(t: Tables) -> DataFrame:
    p = t.part
    after = text_map({"id": "p_partkey", "sku_name": "p_name", "brand": "p_brand", "type": "p_type",
                      "size": "p_size"})
    return explode_envelopes(p, [envelope("sku_info", "r", after, None, F.lit(DIM_T0))], "sku_info")


def province_feed(t: Tables) -> DataFrame:
    after = text_map({"id": "n_nationkey", "name": "n_name", "region_id": "n_regionkey"})
    return explode_envelopes(t.nation, [envelope("base_province", "r", after, None, F.lit(DIM_T0))], "base_province")


def region_feed(t: Tables) -> DataFrame:
    after = text_map({"id": "r_regionkey", "name": "r_name"})
    return explode_envelopes(t.region, [envelope("base_region", "r", after, None, F.lit(DIM_T0))], "base_region")


DIM_FEEDS = {"user_info": user_info_feed, "sku_info": sku_info_feed,
             "base_province": province_feed, "base_region": region_feed}


def dim_ods(t: Tables, tables=None) -> DataFrame:
    names = list(DIM_FEEDS) if tables is None else list(tables)
    out = None
    for n in names:
        d = DIM_FEEDS[n](t)
        out = d if out is None else out.unionByName(d)
    return out
