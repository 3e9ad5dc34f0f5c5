"""Tumbling event-time windows and the windowed aggregates of the DWS layer.

Every aggregate is a ``groupBy(window(ts, size), keys...)`` -- the same code
runs on a static table and on a watermarked stream. Global (unkeyed) windows
need no single task: Spark aggregates partially in every input partition and
only the per-window partials meet in the final stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DATE_FMT, DATETIME_FMT
from ..functions.strings import is_empty
from . import state

WIN = "window"


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Add the epoch-aligned tumbling window (struct start/end)."""
    return df.withColumn(WIN, F.window(F.col(ts), size))


def with_watermark(df: DataFrame, ts: str, lag: str = "0 seconds") -> DataFrame:
    """Event-time watermark; ``ts`` must be TIMESTAMP (not NTZ)."""
    return df.withWatermark(ts, lag)


def decorate_window(df: DataFrame, with_edt: bool = True) -> DataFrame:
    """Window bounds as text -- ``stt``/``edt`` (yyyy-MM-dd HH:mm:ss) and
    ``cur_date`` of the window start -- replacing the window struct."""
    cols = [F.date_format(F.col(WIN + ".start"), DATETIME_FMT).alias("stt")]
    if with_edt:
        cols.append(F.date_format(F.col(WIN + ".end"), DATETIME_FMT).alias("edt"))
    cols.append(F.date_format(F.col(WIN + ".start"), DATE_FMT).alias("cur_date"))
    rest = [F.col(c) for c in df.columns if c != WIN]
    return df.select(*cols, *rest)


def drop_zero(df: DataFrame, cols) -> DataFrame:
    """Keep rows where at least one counter moved."""
    cond = None
    for c in cols:
        e = F.col(c) != 0
        cond = e if cond is None else cond | e
    return df.where(cond)


def _bigint_sum(c: str) -> Column:
    return F.sum(c).cast("bigint").alias(c)


# --------------------------------------------------------------------------
# A1: page views by version / channel / area / is_new
# --------------------------------------------------------------------------

def page_metrics(page_log: DataFrame, uv_flag: Column | None = None) -> DataFrame:
    """One metric row per page view: pv 1, sv 1 when the view starts a
    session (no previous page), the view's duration, and the uv flag."""
    return page_log.select(
        "ts", "vc", "ch", "ar", "is_new",
        (uv_flag if uv_flag is not None else F.lit(0)).cast("bigint").alias("uv_ct"),
        F.when(is_empty("last_page_id"), 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"),
        F.col("during_time").cast("bigint").alias("dur_sum"),
    )


def traffic_window(page_log: DataFrame, size: str = "10 seconds") -> DataFrame:
    """A1 + T2 + W1 + W12: per window and (vc, ch, ar, is_new): unique
    visitors of the day (uv), sessions (sv), page views (pv), duration sum.

    The daily-first-visit flag (T2) only feeds a sum, so instead of flagging
    every row we count the first view per (mid, day) directly: the page views
    are aggregated map-side as they are, the per-(mid, day) first views are a
    second combinable aggregate, and the two partial results are added. No
    row of the big side is shuffled or joined.
    """
    keys = ["vc", "ch", "ar", "is_new"]
    pv = page_metrics(page_log)
    firsts = state.first_of_day(page_log.select("mid", "ts", "event_id", *keys),
                                "mid", "ts", ["event_id"])
    uv = firsts.select("ts", *keys, F.lit(1).cast("bigint").alias("uv_ct"),
                       F.lit(0).cast("bigint").alias("sv_ct"), F.lit(0).cast("bigint").alias("pv_ct"),
                       F.lit(0).cast("bigint").alias("dur_sum"))
    both = pv.unionByName(uv)
    g = (tumble(both, "ts", size).groupBy(WIN, *keys)
         .agg(_bigint_sum("uv_ct"), _bigint_sum("sv_ct"), _bigint_sum("pv_ct"), _bigint_sum("dur_sum")))
    return decorate_window(g)


# --------------------------------------------------------------------------
# A2: home / good_detail daily unique visitors, global window
# --------------------------------------------------------------------------

def home_detail_window(page_log: DataFrame, size: str = "3 seconds") -> DataFrame:
    """X8 + T3 + A2 + W3 + X12: per global window, visitors whose first home
    view of the day / first good_detail view of the day falls in it.
    T3 keeps two independent daily states per mid -- i.e. the key is
    (mid, page_id)."""
    pages = page_log.where(F.col("page_id").isin("home", "good_detail")) \
                    .select("mid", "page_id", "ts", "event_id")
    firsts = state.first_of_day(pages, ["mid", "page_id"], "ts", ["event_id"])
    m = firsts.select("ts",
                      F.when(F.col("page_id") == "home", 1).otherwise(0).alias("home_uv_ct"),
                      F.when(F.col("page_id") == "good_detail", 1).otherwise(0).alias("good_detail_uv_ct"))
    g = tumble(m, "ts", size).groupBy(WIN).agg(_bigint_sum("home_uv_ct"), _bigint_sum("good_detail_uv_ct"))
    return drop_zero(decorate_window(g), ["home_uv_ct", "good_detail_uv_ct"])


# --------------------------------------------------------------------------
# A4: daily logins and returning users, global window
# --------------------------------------------------------------------------

def login_rows(page_log: DataFrame) -> DataFrame:
    """A login is a page view with a user id whose previous page is
    'login' or empty."""
    return page_log.where(~is_empty("uid") &
                          ((F.col("last_page_id") == "login") | is_empty("last_page_id")))


def login_window(page_log: DataFrame, size: str = "3 hours", back_days: int = 8) -> DataFrame:
    """X9 + T5 + A4 + W3: per global window, distinct users logging in for the
    first time that day (uu_ct) and of those the ones returning after
    ``back_days`` or more days (back_ct)."""
    flags = state.login_flags(login_rows(page_log).select("uid", "ts", "event_id"),
                              "uid", "ts", ["event_id"], back_days)
    g = tumble(flags, "ts", size).groupBy(WIN).agg(_bigint_sum("back_ct"), _bigint_sum("uu_ct"))
    return drop_zero(decorate_window(g), ["uu_ct", "back_ct"])


# --------------------------------------------------------------------------
# A3: distinct carting users, global window
# --------------------------------------------------------------------------

def cart_uu_window(cart_add: DataFrame, size: str = "5 seconds", ts: str = "et",
                   tie: str = "id") -> DataFrame:
    """T4 + A3 + W3: per global window, users adding to cart for the first
    time that day."""
    firsts = state.first_of_day(cart_add.select("user_id", ts, tie), "user_id", ts, [tie])
    g = tumble(firsts, ts, size).groupBy(WIN).agg(F.count(F.lit(1)).cast("bigint").alias("cart_add_uu_ct"))
    return decorate_window(g)


# --------------------------------------------------------------------------
# Search keywords per window
# --------------------------------------------------------------------------

def keyword_counts(keywords: DataFrame, size: str = "1 second", ts: str = "et") -> DataFrame:
    """A7 + W5: count(*) per (window start, keyword); like the SQL original,
    the output has ``stt`` and ``cur_date`` but no ``edt`` (Q20)."""
    g = tumble(keywords, ts, size).groupBy(WIN, "keyword").agg(F.sum("cnt").cast("bigint").alias("keyword_count"))
    return decorate_window(g, with_edt=False)


#: (window, text) pairs of a task that gives each of them its text's keywords.
SPREAD_SEARCHES = 4096


def windowed_searches(searches: DataFrame, size: str = "1 second", ts: str = "ts", ref: str = "item") -> DataFrame:
    """(window, ref, n): searches counted per window and text."""
    return tumble(searches.select(F.col(ts).alias("et"), F.col(ref).alias("ref")), "et", size) \
        .groupBy(WIN, "ref").agg(F.count(F.lit(1)).alias("n"))


def search_tasks(asked: DataFrame) -> int:
    """Tasks for the join of ``windowed_searches`` with the texts' keywords. Its
    result is hundreds of times its input, so tasks sized by input bytes would
    hold more and more counts as searches grow."""
    return max(1, -(-asked.count() // SPREAD_SEARCHES))


def searched_keyword_counts(asked: DataFrame, per_text: DataFrame, tasks: int) -> DataFrame:
    """A7 from the windowed searches (window, ref, n) and the keyword counts of
    the texts they refer to (ref, keyword, cnt): searches are counted per
    (window, text) before the join fans out to a text's keywords, so a text
    searched often in a window is joined once. ``tasks``: :func:`search_tasks`;
    ``per_text`` partitioned alike (``text.searched_texts``) is joined as it is."""
    k = asked.repartition(tasks, "ref").join(per_text, "ref").groupBy(WIN, "keyword") \
        .agg(F.sum(F.col("n") * F.col("cnt")).cast("bigint").alias("keyword_count"))
    return decorate_window(k, with_edt=False)


# --------------------------------------------------------------------------
# Order amounts per SKU and per province
# --------------------------------------------------------------------------

AMOUNT = "decimal(20,4)"
SUM_AMOUNT = "decimal(38,4)"


def latest_details(versions: DataFrame, deduped: bool = False) -> DataFrame:
    """T7 in front of the order windows: one row per detail id, its last
    version (Q15: the batch twin of the retraction dedup -- summing the
    +/- rows of T6 gives exactly these sums), with event time ``et``.
    ``deduped=True`` when the input is already the upsert fact table (one
    row per id), e.g. ``facts.order_detail_fact``."""
    last = versions if deduped else state.keep_latest(versions, "id", [F.col("replay_order")])
    return last.withColumn("et", F.timestamp_millis(F.col("ts_ms")))


#: Detail columns that the order windows read.
PROVINCE_IN = ["id", "ts_ms", "province_id", "order_id", "split_total_amount"]
SKU_IN = ["id", "ts_ms", "sku_id", "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def province_window(versions: DataFrame, provinces: DataFrame, size: str = "2 seconds",
                    deduped: bool = False) -> DataFrame:
    """T6/T7 + A6 + W2 + J6: per window and province, distinct orders and
    summed order amount, then the province name (looked up after the
    aggregate, so the lookup touches one row per group)."""
    from . import dims
    d = latest_details(versions, deduped).select(
        "et", "province_id", "order_id", F.col("split_total_amount").cast(AMOUNT).alias("amt"))
    g = (tumble(d, "et", size).groupBy(WIN, "province_id")
         .agg(F.count_distinct("order_id").cast("bigint").alias("order_count"),
              F.sum("amt").cast(SUM_AMOUNT).alias("order_amount")))
    g = dims.with_province(g, provinces)
    return decorate_window(g).select("stt", "edt", "cur_date", "province_id", "province_name",
                                     "order_count", "order_amount")


SKU_OUT = ["stt", "edt", "cur_date", "trademark_id", "trademark_name", "category1_id", "category1_name",
           "category2_id", "category2_name", "category3_id", "category3_name", "sku_id", "sku_name",
           "spu_id", "spu_name", "original_amount", "activity_reduce_amount", "coupon_reduce_amount",
           "order_amount"]


def sku_window(versions: DataFrame, wide_sku: DataFrame, size: str = "10 seconds",
               deduped: bool = False) -> DataFrame:
    """T6/T7 + A5 + W1 + J7: four decimal sums per window and SKU, then one
    left join to the pre-joined wide SKU dimension (Q13: event time; the
    processing-time variant exists only for streams)."""
    from . import dims
    d = latest_details(versions, deduped).select(
        "et", "sku_id",
        F.col("split_original_amount").cast(AMOUNT).alias("original_amount"),
        F.col("split_activity_amount").cast(AMOUNT).alias("activity_reduce_amount"),
        F.col("split_coupon_amount").cast(AMOUNT).alias("coupon_reduce_amount"),
        F.col("split_total_amount").cast(AMOUNT).alias("order_amount"))
    # a window is sent as its start, of which it is the window again
    g = (tumble(d, "et", size).withColumn("et", F.col(WIN + ".start")).groupBy("et", "sku_id")
         .agg(*[F.sum(c).cast(SUM_AMOUNT).alias(c) for c in
                ("original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")]))
    g = tumble(dims.with_sku(g, wide_sku), "et", size).drop("et").withColumnRenamed("tm_id", "trademark_id") \
            .withColumnRenamed("tm_name", "trademark_name")
    return decorate_window(g).select(*SKU_OUT)


# --------------------------------------------------------------------------
# Event time from alternative fields
# --------------------------------------------------------------------------

def event_time_from(df: DataFrame, candidates, unit: str = "s", out: str = "et") -> DataFrame:
    """Event time from the first non-null of ``candidates`` (e.g.
    ``block_timestamp`` then ``timestamp``), in seconds (``unit='s'``) or
    milliseconds; add ``withWatermark(out, lag)`` on a stream."""
    v = F.coalesce(*[F.col(c).cast("bigint") for c in candidates])
    return df.withColumn(out, F.timestamp_seconds(v) if unit == "s" else F.timestamp_millis(v))


def batch_event_time(df: DataFrame, arr: str, field: str = "window_start_time", unit: str = "s",
                     out: str = "et") -> DataFrame:
    """Records that carry a batch of elements take the time of the
    batch's first element."""
    v = F.element_at(F.col(arr), 1)[field].cast("bigint")
    return df.withColumn(out, F.timestamp_seconds(v) if unit == "s" else F.timestamp_millis(v))
