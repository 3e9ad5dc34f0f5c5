"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives its inputs from the given tables (martflow.sources) and
runs one operator chain over all of their rows. The DuckDB twins live in
``martflow.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import state, windows
from ..sources import retail
from ..sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# -- traffic layer ----------------------------------------------------------

@query("traffic_vc_ch_ar_isnew_window")
def q_traffic(spark, sf_dir):
    return windows.traffic_window(retail.page_log(_t(spark, sf_dir)), "10 seconds")


@query("traffic_vc_ch_ar_isnew_window_1h")
def q_traffic_1h(spark, sf_dir):
    return windows.traffic_window(retail.page_log(_t(spark, sf_dir)), "1 hour")


@query("visitor_is_new_repair")
def q_repair(spark, sf_dir):
    pl = retail.page_log(_t(spark, sf_dir)).select("event_id", "mid", "ts", "is_new")
    return state.repair_is_new(pl, "mid", "ts", ["event_id"]).select("event_id", "mid", "is_new")


@query("home_detail_uv_window")
def q_home_detail(spark, sf_dir):
    return windows.home_detail_window(retail.page_log(_t(spark, sf_dir)), "3 seconds")


@query("home_detail_uv_window_1d")
def q_home_detail_1d(spark, sf_dir):
    return windows.home_detail_window(retail.page_log(_t(spark, sf_dir)), "1 day")


@query("user_login_window")
def q_login(spark, sf_dir):
    return windows.login_window(retail.page_log(_t(spark, sf_dir)), "3 hours")


@query("user_login_window_1d")
def q_login_1d(spark, sf_dir):
    return windows.login_window(retail.page_log(_t(spark, sf_dir)), "1 day")


# -- fact layer (change feed -> DWD facts) -----------------------------------

from ..operators import facts  # noqa: E402

DETAIL_FEEDS = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def _detail(t, **options):
    return facts.order_detail_fact(retail.ods(t, DETAIL_FEEDS), **options)


def _details(t):
    """Makes the detail facts; the facts of cancelled and paid orders have their orders' rows joined in it."""
    return partial(_detail, t)


@query("cart_add_fact")
def q_cart_add(spark, sf_dir):
    return facts.cart_add_fact(retail.ods(_t(spark, sf_dir), ["cart_info"]))


@query("order_detail_fact")
def q_order_detail(spark, sf_dir):
    return _detail(_t(spark, sf_dir))


@query("order_cancel_fact")
def q_order_cancel(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.order_cancel_fact(_details(t), retail.ods(t, ["order_info"]))


@query("payment_fact")
def q_payment(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.payment_fact(_details(t), retail.ods(t, ["refund_payment"]), retail.base_dic(spark))


@query("payment_fact_interval")
def q_payment_interval(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.payment_fact(_details(t), retail.ods(t, ["refund_payment"]), retail.base_dic(spark),
                              interval=("30 minutes", "5 seconds"))


@query("payment_fact_versioned")
def q_payment_versioned(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.payment_fact_versioned(_details(t), retail.ods(t, ["refund_payment"]), retail.base_dic_feed(t))


@query("order_detail_changes")
def q_order_detail_changes(spark, sf_dir):
    return facts.order_detail_changes(retail.ods(_t(spark, sf_dir), DETAIL_FEEDS))


@query("refund_fact")
def q_refund(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.refund_fact(retail.ods(t, ["order_refund_info", "order_info"]), retail.base_dic(spark))


@query("comment_fact")
def q_comment(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.comment_fact(retail.ods(t, ["comment_info"]), retail.base_dic(spark))


# -- order windows, dedup ------------------------------------------------------

from ..operators import dims, segment, text  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


# The default replay order by columns: four of its own (sku, supplier, price and
# quantity as numbers) beside those that the rows carry anyway.
REPLAY_OWN = ["k1", "k2", "k3", "k4"]
REPLAY_ORDER = ["ts_ms", *REPLAY_OWN, "split_activity_amount", "split_coupon_amount"]


def _amounts(df):
    return df.select("id", "ts_ms", *[f"replay_order.{k}" for k in REPLAY_OWN], *[F.col(c).cast("decimal(20,4)").alias(c) for c in AMOUNTS])


def _detail_amounts(t):
    """Detail versions that have an order, with numeric amounts -- nothing
    else is needed for the per-id dedup, so nothing else is joined."""
    return _amounts(facts.order_detail_rows(retail.ods(t, ("order_detail", "order_info"))))


@query("order_dedup_retract")
def q_retract(spark, sf_dir):
    v = _detail_amounts(_t(spark, sf_dir))
    return state.retract_duplicates(v, "id", REPLAY_ORDER, AMOUNTS, sign_col="sign").drop(*REPLAY_OWN)


@query("order_dedup_latest")
def q_latest(spark, sf_dir):
    v = _detail_amounts(_t(spark, sf_dir))
    return state.keep_latest(v, "id", REPLAY_ORDER).drop(*REPLAY_OWN)


@query("order_dedup_hold")
def q_order_hold(spark, sf_dir):
    v = _detail_amounts(_t(spark, sf_dir))
    return state.hold_and_flush(v, "id", "ts_ms", REPLAY_ORDER, 5000).drop(*REPLAY_OWN)


@query("visitor_page_hold")
def q_visitor_hold(spark, sf_dir):
    """A visitor's newest page of each hold of six hours."""
    pl = retail.page_log(_t(spark, sf_dir)).select("mid", "ts_ms", "event_id", "page_id")
    return state.hold_and_flush(pl, "mid", "ts_ms", ["event_id"], 6 * 3_600_000)


@query("province_order_window")
def q_province(spark, sf_dir):
    t = _t(spark, sf_dir)
    return windows.province_window(_detail(t, columns=windows.PROVINCE_IN), retail.province_dim(t), "2 seconds", deduped=True)


@query("province_order_window_1d")
def q_province_1d(spark, sf_dir):
    t = _t(spark, sf_dir)
    return windows.province_window(_detail(t, columns=windows.PROVINCE_IN), retail.province_dim(t), "1 day", deduped=True)


@query("sku_order_window")
def q_sku(spark, sf_dir):
    t = _t(spark, sf_dir)
    return windows.sku_window(_detail(t, columns=windows.SKU_IN), dims.wide_sku_dim(retail.sku_dims(t)), "10 seconds", deduped=True)


@query("sku_order_window_1d")
def q_sku_1d(spark, sf_dir):
    t = _t(spark, sf_dir)
    return windows.sku_window(_detail(t, columns=windows.SKU_IN), dims.wide_sku_dim(retail.sku_dims(t)), "1 day", deduped=True)


def _cart_add_et(t):
    c = facts.cart_add_fact(retail.ods(t, ["cart_info"]))
    return c.withColumn("et", F.timestamp_millis("ts"))


@query("cart_add_uu_window")
def q_cart_uu(spark, sf_dir):
    return windows.cart_uu_window(_cart_add_et(_t(spark, sf_dir)), "5 seconds")


@query("cart_add_uu_window_1d")
def q_cart_uu_1d(spark, sf_dir):
    return windows.cart_uu_window(_cart_add_et(_t(spark, sf_dir)), "1 day")


# -- keywords and text -----------------------------------------------------------

def _keyword_window(t, size):
    searches = text.search_rows(retail.page_log(t))
    asked = windows.windowed_searches(searches, size)
    tasks = windows.search_tasks(asked)
    return windows.searched_keyword_counts(asked, text.searched_texts(searches, t.documents, tasks=tasks), tasks)


@query("keyword_window")
def q_keyword(spark, sf_dir):
    return _keyword_window(_t(spark, sf_dir), "1 second")


@query("keyword_window_1d")
def q_keyword_1d(spark, sf_dir):
    return _keyword_window(_t(spark, sf_dir), "1 day")


@query("keyword_tokens")
def q_keyword_tokens(spark, sf_dir):
    d = _t(spark, sf_dir).documents
    return text.explode_keywords(d.select("text"), "text").groupBy("keyword") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("keyword_count"))


@query("keyword_segment")
def q_keyword_segment(spark, sf_dir):
    """Tokens of all texts cut by a dictionary of the texts' own short words
    (2 to 8 letters, one occurrence in a hundred documents or more)."""
    d = _t(spark, sf_dir).documents
    words = segment.frequent_words(d, "text", 2, 8, d.agg(F.count(F.lit(1)) / 100).scalar())
    return segment.segment_counts(d, "text", words)


# The word list of the membership check.
WORD_LIST = ["password", "secret", "token", "apikey", "passwd", "private", "ssn", "license"]


@query("sensitive_word_flag")
def q_sensitive(spark, sf_dir):
    d = _t(spark, sf_dir).documents
    words = text.explode_keywords(d.select("text"), "text", "word")
    wl = F.broadcast(spark.createDataFrame([(w,) for w in WORD_LIST], "word string"))
    return text.flag_words(words, "word", wl)


@query("text_charset_filter")
def q_charset(spark, sf_dir):
    d = _t(spark, sf_dir).documents
    toks = F.regexp_extract_all(F.col("text"), F.lit("[^ \t\n\r\f]+"), 0)
    from ..functions.strings import CHARSET_PATTERN
    return d.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"),
                    F.size(F.filter(toks, lambda x: x.rlike(CHARSET_PATTERN))).cast("bigint").alias("n_clean"))


# Markup of the test pages: title, headline and link texts.
PAGE_ITEM_PATTERN = r"<(?:title|h1|a)(?: [^>]*)?>([^<]*)</(?:title|h1|a)>"


@query("page_titles")
def q_titles(spark, sf_dir):
    return text.page_titles(_t(spark, sf_dir).pages, pattern=PAGE_ITEM_PATTERN)


# -- log split -------------------------------------------------------------------

from ..operators import logsplit  # noqa: E402
from ..sources import applog  # noqa: E402


def _split(spark, sf_dir):
    return logsplit.split_log(applog.app_log_topic(_t(spark, sf_dir)))


@query("log_split_page")
def q_split_page(spark, sf_dir):
    p = _split(spark, sf_dir)["page"]
    return p.select(F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"),
                    F.col("common.uid").alias("uid"), F.col("common.is_new").alias("is_new"),
                    "page.page_id", "page.last_page_id", "page.item", "page.during_time", "ts")


@query("log_split_start")
def q_split_start(spark, sf_dir):
    s = _split(spark, sf_dir)["start"]
    return s.select(F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"),
                    F.col("common.is_new").alias("is_new"), "start.entry", "start.loading_time", "ts")


@query("log_split_err")
def q_split_err(spark, sf_dir):
    e = _split(spark, sf_dir)["err"]
    return e.select(F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"),
                    F.col("common.is_new").alias("is_new"), "err.error_code", "err.msg",
                    F.col("start").isNotNull().alias("has_start"), "ts")


@query("log_split_display")
def q_split_display(spark, sf_dir):
    d = _split(spark, sf_dir)["display"]
    return d.select(F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"), "page.page_id",
                    "display.item", "display.item_type", "display.pos_id", "display.pos_seq", "ts")


@query("log_split_action")
def q_split_action(spark, sf_dir):
    a = _split(spark, sf_dir)["action"]
    return a.select(F.col("common.sid").alias("sid"), F.col("common.mid").alias("mid"), "page.page_id",
                    "action.action_id", "action.item", F.col("action.ts").alias("action_ts"))


@query("log_split_dirty")
def q_split_dirty(spark, sf_dir):
    d = _split(spark, sf_dir)["dirty"]
    return d.select(F.regexp_extract("value", '"sid":"([^"]*)"', 1).alias("sid"))


# -- routing (config-driven splits) ----------------------------------------------

from ..operators import routing  # noqa: E402
from ..sources import cdc as cdc_src  # noqa: E402
from ..sources import config as cfg_src  # noqa: E402


@query("dim_route")
def q_dim_route(spark, sf_dir):
    t = _t(spark, sf_dir)
    routed = routing.route_dims(retail.dim_ods(t), cfg_src.dim_config_feed(spark), db="stream_retail")
    return routing.fold_routed_dims(routed)


@query("dim_fold")
def q_dim_fold(spark, sf_dir):
    feed = retail.user_info_feed(_t(spark, sf_dir))
    return routing.fold_dimension_table(feed, "id", ["id", "name", "nation_id", "segment", "acctbal"])


def _ods_topic(t, tables):
    """The change feed as JSON text, parsed back with the envelope parser."""
    text_topic = cdc_src.to_topic_value(retail.ods(t, tables)).observe("ods_topic", F.count(F.lit(1)).alias("rows"))
    good, _bad = cdc_src.parse_cdc(text_topic)
    return good


@query("fact_route")
def q_fact_route(spark, sf_dir):
    t = _t(spark, sf_dir)
    ods = _ods_topic(t, None)  # the whole topic
    r = routing.route_facts(ods, cfg_src.fact_config_feed(spark))
    return r.select("sink_table", F.col("data")["id"].alias("row_id"), F.explode("data").alias("column", "value"))


# -- re-aimed utilities, scalar functions ------------------------------------------

from .. import functions as fn  # noqa: E402
from ..operators import misc  # noqa: E402


@query("day_partition_spine")
def q_spine(spark, sf_dir):
    return misc.daily_counts_on_spine(_t(spark, sf_dir).orders, "o_orderdate")


def mixed_epoch(e):
    """Event time as producers send it: seconds for views, milliseconds for
    most others, and unusable text for errors."""
    ms = fn.epoch_ms("ts")
    return (F.when(F.col("event_type") == "view", (ms / 1000).cast("bigint").cast("string"))
             .when(F.col("event_type") == "error", F.lit("n/a"))
             .otherwise(ms.cast("string")))


@query("event_day_partition")
def q_event_day(spark, sf_dir):
    e = _t(spark, sf_dir).events
    d = misc.with_event_day(e.select(mixed_epoch(e).alias("v")), "v")
    return d.groupBy("day").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("salted_key_buckets")
def q_buckets(spark, sf_dir):
    return misc.bucket_counts(_t(spark, sf_dir).customer, "c_custkey", 128)


# Keys known to be hot, with buckets of their own.
HOT_KEYS = [("1", "hot1"), ("7", "hot7"), ("42", "hot42")]


@query("salted_key_buckets_hot")
def q_buckets_hot(spark, sf_dir):
    hot = F.broadcast(spark.createDataFrame(HOT_KEYS, "key_lower string, bucket string"))
    return misc.bucket_counts(_t(spark, sf_dir).orders, "o_custkey", 128, hot)


@query("ordered_list_append")
def q_ordered_list(spark, sf_dir):
    c = _t(spark, sf_dir).conversations
    return misc.ordered_list(c, "conv_id", "turn", "role", "roles") \
               .select("conv_id", F.array_join("roles", ",").alias("roles"))


@query("scan_limit")
def q_scan_limit(spark, sf_dir):
    return misc.scan_limit(_t(spark, sf_dir).part.select("p_partkey", "p_name", "p_brand"), "p_partkey", 100)


@query("table_row_count")
def q_row_count(spark, sf_dir):
    from ..sources.tables import TABLES
    t = _t(spark, sf_dir)
    out = None
    for name in TABLES:
        c = misc.count_rows(t.read(name)).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


@query("scalar_dates")
def q_scalar_dates(spark, sf_dir):
    e = _t(spark, sf_dir).events.select("event_id", fn.epoch_ms("ts").alias("ms"))
    return e.select(
        "event_id", "ms",
        fn.ms_to_date("ms").alias("date"), fn.ms_to_datetime("ms").alias("datetime"),
        fn.ms_to_partition("ms").alias("day"), fn.format_ms("ms", "yyyy/MM/dd HH").alias("hour_text"),
        fn.datetime_to_ms(fn.ms_to_datetime("ms")).alias("second_ms"),
        fn.date_to_ms(fn.ms_to_date("ms")).alias("midnight_ms"),
        fn.days_between(fn.ms_to_date("ms"), F.lit("2024-01-01")).alias("day_no"),
        fn.previous_day("ms").alias("prev_date"),
        fn.flexible_date(F.col("ms").cast("string")).alias("date_from_text"))


@query("scalar_strings")
def q_scalar_strings(spark, sf_dir):
    p = _t(spark, sf_dir).part
    return p.select(
        "p_partkey",
        fn.join_list(F.array("p_brand", "p_type"), ",").alias("brand_type"),
        fn.upper_first("p_name").alias("name_cap"),
        fn.lower_first(F.upper("p_name")).alias("name_low"),
        fn.pad("p_size", 4).alias("size_pad"),
        fn.repeat_char("*", F.col("p_size") % 5).alias("stars"),
        fn.is_blank(F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(F.col("p_name"))).alias("blank"),
        fn.is_empty(F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_name"))).alias("empty"))


@query("scalar_rowkey")
def q_scalar_rowkey(spark, sf_dir):
    p = _t(spark, sf_dir).part
    cols = ["p_partkey", "p_brand", "p_type"]
    return p.select("p_partkey", fn.row_key(cols, "_").alias("rk"),
                    fn.row_key(cols, "|", md5_fields=True).alias("rk_md5_fields"),
                    fn.row_key(cols, "_", md5_all=True).alias("rk_md5"))


# -- watermarks over recorded arrivals, event time from other fields, topics re-read ----

from ..operators import lateness  # noqa: E402

WINDOW_MS, STEP_MS = 10_000, 10_000


def _page_counts(rows):
    metrics = windows.page_metrics(rows)
    return windows.decorate_window(windows.tumble(metrics, "ts", "10 seconds").groupBy(windows.WIN, "vc", "ch", "ar", "is_new").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("sv_ct", "pv_ct", "dur_sum")]))


@query("page_late_rows")
def q_late_rows(spark, sf_dir):
    _, late = lateness.split_late(retail.page_arrivals(_t(spark, sf_dir)), "arrival_ms", "ts_ms", WINDOW_MS, STEP_MS, 3_000)
    return late.select("event_id", "mid", "page_id", "ts_ms", "arrival_ms", "watermark")


@query("page_on_time_window")
def q_on_time(spark, sf_dir):
    on_time, _ = lateness.split_late(retail.page_arrivals(_t(spark, sf_dir)), "arrival_ms", "ts_ms", WINDOW_MS, STEP_MS, 3_000)
    return _page_counts(on_time)


@query("page_on_time_window_monotonous")
def q_on_time_monotonous(spark, sf_dir):
    on_time, _ = lateness.split_late(retail.page_arrivals(_t(spark, sf_dir)), "arrival_ms", "ts_ms", WINDOW_MS, STEP_MS)
    return _page_counts(on_time)


@query("page_arrival_window")
def q_arrival_window(spark, sf_dir):
    return _page_counts(lateness.arrival_time(retail.page_arrivals(_t(spark, sf_dir)), "arrival_ms"))


@query("event_time_fallback")
def q_event_time_fallback(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    seconds = F.floor(fn.epoch_ms("o_orderdate") / 1000)
    rows = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", seconds).alias("block_timestamp"),
                    F.when(F.col("o_orderkey") % 11 != 0, seconds + 3_600).alias("timestamp"))
    return windows.event_time_from(rows, ["block_timestamp", "timestamp"]).select(
        "o_orderkey", F.unix_millis("et").alias("et_ms"), F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("et"))


@query("batch_event_time")
def q_batch_event_time(spark, sf_dir):
    # a sender's batch: sixteen views in the order of their ids
    p = retail.page_log(_t(spark, sf_dir)).select(
        F.floor(F.col("event_id") / 16).alias("batch_id"),
        F.struct("event_id", F.col("ts_ms").alias("window_start_time"), "during_time").alias("r"))
    batches = p.groupBy("batch_id").agg(F.sort_array(F.collect_list("r")).alias("items"))
    return windows.batch_event_time(batches, "items", unit="ms").select(
        "batch_id", F.unix_millis("et").alias("et_ms"), F.size("items").cast("bigint").alias("n"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["during_time"], F.lit(0))).alias("during_time"))


@query("page_topic_rows")
def q_page_topic(spark, sf_dir):
    values = retail.page_topic(_t(spark, sf_dir)).observe("page_topic", F.count(F.lit(1)).alias("rows"))
    return cdc_src.page_topic_table(values, lag=None)[0].drop("ts")


@query("page_topic_dirty")
def q_page_topic_dirty(spark, sf_dir):
    values = retail.page_topic(_t(spark, sf_dir)).observe("page_topic", F.count(F.lit(1)).alias("rows"))
    return cdc_src.page_topic_table(values, lag=None)[1]


@query("order_detail_topic_rows")
def q_detail_topic(spark, sf_dir):
    from ..operators.facts import ORDER_DETAIL_COLS
    fact = QUERIES["order_detail_fact"](spark, sf_dir)
    values = fact.select(F.to_json(F.struct(*ORDER_DETAIL_COLS)).alias("value")).observe("detail_topic", F.count(F.lit(1)).alias("rows"))
    rows = cdc_src.fact_topic_table(values, ORDER_DETAIL_COLS)[0]
    return rows.withColumn("et", F.date_format("et", "yyyy-MM-dd HH:mm:ss"))


@query("camel_case_columns")
def q_camel(spark, sf_dir):
    from ..functions.strings import camel_columns
    return camel_columns(_t(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment"))
