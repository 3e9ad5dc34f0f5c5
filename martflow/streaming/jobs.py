"""Streaming job builders: the batch operators on Structured Streaming.

Stateless steps (parse, gate, project, explode, window aggregates) are the
batch functions themselves. Keyed state goes through the processors in
``martflow.streaming.processors``; each stateful step passes its event-time
column on (``eventTimeColumnName``) so a following window aggregate still
has a watermark. Output mode is append: a window is emitted once, after the
watermark passes its end; rows later than the watermark are dropped (W11,
counted in ``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import windows
from ..operators.cdc import image as cdc_image
from ..operators.windows import WIN, decorate_window, tumble
from .processors import ConfigRouter, FirstOfDay, IdleJoin, KeepLatest, LoginFlags, RepairIsNew, RetractDuplicates

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store (T11); every
    builder below that keeps keyed state sets it on its session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType(list(schema.fields) + list(fields))


def _time_mode(ttl_ms) -> str:
    return "ProcessingTime" if ttl_ms else "None"


# --------------------------------------------------------------------------
# keyed state steps
# --------------------------------------------------------------------------

def first_of_day_stream(stream: DataFrame, key, ts: str, ties, emit: str = "flag", out: str = "uv_ct",
                        lag: str = "1 second", ttl_ms: int | None = None) -> DataFrame:
    """T2/T3 (``emit='flag'``) or T4 (``emit='first'``) on a stream."""
    use_rocksdb_state(stream.sparkSession)
    keys = [key] if isinstance(key, str) else list(key)
    schema = stream.schema if emit == "first" else _with(stream.schema, T.StructField(out, T.LongType()))
    return (stream.withWatermark(ts, lag).groupBy(*keys)
            .transformWithStateInPandas(FirstOfDay(ts, list(ties), emit, out, ttl_ms), schema, "Append",
                                        _time_mode(ttl_ms), eventTimeColumnName=ts))


def repair_is_new_stream(stream: DataFrame, key: str, ts: str, ties, flag: str = "is_new",
                         lag: str = "1 second", ttl_ms: int | None = None) -> DataFrame:
    """T1 on a stream (Q5: no TTL unless asked)."""
    use_rocksdb_state(stream.sparkSession)
    return (stream.withWatermark(ts, lag).groupBy(key)
            .transformWithStateInPandas(RepairIsNew(ts, list(ties), flag, ttl_ms), stream.schema, "Append",
                                        _time_mode(ttl_ms), eventTimeColumnName=ts))


def login_flags_stream(stream: DataFrame, key: str, ts: str, ties, back_days: int = 8,
                       lag: str | None = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """T5 on a stream. ``lag=None`` when the caller already set the
    watermark upstream (e.g. before a filter, so that every source row
    advances event time)."""
    use_rocksdb_state(stream.sparkSession)
    schema = _with(stream.schema, T.StructField("back_ct", T.LongType()), T.StructField("uu_ct", T.LongType()))
    s = stream if lag is None else stream.withWatermark(ts, lag)
    return (s.groupBy(key)
            .transformWithStateInPandas(LoginFlags(ts, list(ties), back_days, ttl_ms), schema, "Append", _time_mode(ttl_ms),
                                        eventTimeColumnName=ts))


def retract_stream(stream: DataFrame, key: str, order, measures, ts: str | None = None,
                   lag: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """T6 on a stream: rows plus negated predecessors, column ``sign``."""
    use_rocksdb_state(stream.sparkSession)
    cols = stream.columns
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields)
    schema = _with(stream.schema, T.StructField("sign", T.IntegerType()))
    s = stream.withWatermark(ts, lag) if ts else stream
    return (s.groupBy(key)
            .transformWithStateInPandas(RetractDuplicates(cols, list(order), list(measures), ddl, ttl_ms),
                                        schema, "Append", _time_mode(ttl_ms),
                                        eventTimeColumnName=ts or ""))


def keep_latest_stream(stream: DataFrame, key: str, order, delay_ms: int = 5000, ttl_ms: int | None = None) -> DataFrame:
    """T7 on a stream: a key's newest record, emitted ``delay_ms`` of processing
    time after the first one arrived."""
    use_rocksdb_state(stream.sparkSession)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields)
    return stream.groupBy(key).transformWithStateInPandas(
        KeepLatest(stream.columns, list(order), ddl, delay_ms, ttl_ms), stream.schema, "Append", "ProcessingTime")


# --------------------------------------------------------------------------
# windowed jobs (``ttl_ms``: processing-time life of the keyed state)
# --------------------------------------------------------------------------

def traffic_window_stream(page_log: DataFrame, size: str = "10 seconds", lag: str = "1 second",
                          ttl_ms: int | None = None) -> DataFrame:
    """A1 + T2 + W1 + W6 on a page-log stream (``ts`` TIMESTAMP)."""
    keys = ["vc", "ch", "ar", "is_new"]
    base = page_log.select("mid", "ts", "event_id", "last_page_id", "during_time", *keys)
    flagged = first_of_day_stream(base, "mid", "ts", ["event_id"], "flag", "uv_ct", lag, ttl_ms)
    m = windows.page_metrics(flagged, F.col("uv_ct"))
    g = tumble(m, "ts", size).groupBy(WIN, *keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")])
    return decorate_window(g)


def home_detail_window_stream(page_log: DataFrame, size: str = "3 seconds", lag: str = "3 seconds",
                              ttl_ms: int | None = None) -> DataFrame:
    """X8 + T3 + A2 + W3 on a page-log stream: daily first home / good_detail
    view per visitor (two independent states = key (mid, page_id)). The
    watermark is set before the page filter."""
    use_rocksdb_state(page_log.sparkSession)
    pages = page_log.withWatermark("ts", lag).where(F.col("page_id").isin("home", "good_detail")) \
                    .select("mid", "page_id", "ts", "event_id")
    schema = pages.schema
    firsts = (pages.groupBy("mid", "page_id")
              .transformWithStateInPandas(FirstOfDay("ts", ["event_id"], "first", ttl_ms=ttl_ms), schema, "Append", _time_mode(ttl_ms),
                                          eventTimeColumnName="ts"))
    m = firsts.select("ts", F.when(F.col("page_id") == "home", 1).otherwise(0).alias("home_uv_ct"),
                      F.when(F.col("page_id") == "good_detail", 1).otherwise(0).alias("good_detail_uv_ct"))
    g = tumble(m, "ts", size).groupBy(WIN).agg(F.sum("home_uv_ct").cast("bigint").alias("home_uv_ct"),
                                               F.sum("good_detail_uv_ct").cast("bigint").alias("good_detail_uv_ct"))
    return windows.drop_zero(decorate_window(g), ["home_uv_ct", "good_detail_uv_ct"])


def cart_uu_window_stream(cart_add: DataFrame, size: str = "5 seconds", ts: str = "et",
                          lag: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """T4 + A3 + W3 + W7 on a cart-add stream."""
    firsts = first_of_day_stream(cart_add.select("user_id", ts, "id"), "user_id", ts, ["id"], "first", lag=lag, ttl_ms=ttl_ms)
    g = tumble(firsts, ts, size).groupBy(WIN).agg(F.count(F.lit(1)).cast("bigint").alias("cart_add_uu_ct"))
    return decorate_window(g)


def login_window_stream(page_log: DataFrame, size: str = "3 hours", back_days: int = 8,
                        lag: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """X9 + T5 + A4 + W3 on a page-log stream. The watermark is set on the
    whole page stream, before the login filter: event time advances with
    every page view, not only with logins."""
    rows = windows.login_rows(page_log.withWatermark("ts", lag)).select("uid", "ts", "event_id")
    flags = login_flags_stream(rows, "uid", "ts", ["event_id"], back_days, lag=None, ttl_ms=ttl_ms)
    g = tumble(flags, "ts", size).groupBy(WIN).agg(F.sum("back_ct").cast("bigint").alias("back_ct"),
                                                   F.sum("uu_ct").cast("bigint").alias("uu_ct"))
    return windows.drop_zero(decorate_window(g), ["uu_ct", "back_ct"])


def keyword_window_stream(keywords: DataFrame, size: str = "1 second", ts: str = "et",
                          lag: str | None = "0 seconds") -> DataFrame:
    """A7 + W5 + W7: keyword rows (ts, keyword, cnt) counted per window.
    ``lag=None`` when the watermark was set upstream (on the page topic)."""
    k = keywords if lag is None else keywords.withWatermark(ts, lag)
    return windows.keyword_counts(k, size, ts)


def province_window_stream(details: DataFrame, provinces: DataFrame, order: list[str],
                           size: str = "2 seconds", lag: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """T6 + A6 + W2 + J6 on an order-detail stream (``et`` TIMESTAMP, replay
    order given as scalar columns ``order``).

    Amounts are summed over the +/- rows, so each superseded version cancels
    in its own window. Distinct orders use ``size(collect_set)`` over the
    positive rows (exact; ``count_distinct`` is refused on streams).
    Q15 caveats, kept as in the original: a retraction keeps its old time and
    lands in the old window -- if that window already closed it is dropped as
    late, so batch (last version per id) equals the stream only when the
    watermark delay covers the replay gap; a window holding only superseded
    versions is still emitted (amount 0); order ids are never retracted.
    """
    from ..operators import dims
    d = details.select("id", "et", *order, "province_id", "order_id",
                       F.col("split_total_amount").cast("decimal(20,4)").alias("amt"))
    r = retract_stream(d, "id", list(order), ["amt"], ts="et", lag=lag, ttl_ms=ttl_ms)
    g = tumble(r, "et", size).groupBy(WIN, "province_id").agg(
        F.size(F.collect_set(F.when(F.col("sign") > 0, F.col("order_id")))).cast("bigint").alias("order_count"),
        F.sum("amt").cast("decimal(38,4)").alias("order_amount"))
    return decorate_window(dims.with_province(g, provinces)).select(
        "stt", "edt", "cur_date", "province_id", "province_name", "order_count", "order_amount")


def sku_window_stream(details: DataFrame, wide_sku: DataFrame, order: list[str], size: str = "10 seconds",
                      lag: str = "0 seconds", processing_time: bool = False, ttl_ms: int | None = None) -> DataFrame:
    """T6 + A5 + J7 on an order-detail stream: the four amounts summed over
    the +/- rows per window and SKU, then one lookup in the wide SKU
    dimension. ``processing_time=True`` windows on arrival time instead
    (W4, the original's mode; Q13) -- run it in update mode."""
    from ..operators import dims
    amounts = {"original_amount": "split_original_amount", "activity_reduce_amount": "split_activity_amount",
               "coupon_reduce_amount": "split_coupon_amount", "order_amount": "split_total_amount"}
    d = details.select("id", "et", *order, "sku_id",
                       *[F.col(src).cast("decimal(20,4)").alias(dst) for dst, src in amounts.items()])
    r = retract_stream(d, "id", list(order), list(amounts), ts="et", lag=lag, ttl_ms=ttl_ms)
    r = processing_time_window(r, size) if processing_time else tumble(r, "et", size)
    g = r.groupBy(WIN, "sku_id").agg(*[F.sum(c).cast("decimal(38,4)").alias(c) for c in amounts])
    g = dims.with_sku(g, wide_sku).withColumnRenamed("tm_id", "trademark_id") \
            .withColumnRenamed("tm_name", "trademark_name")
    return decorate_window(g).select(*windows.SKU_OUT)


def processing_time_window(df: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Tumbling window on processing time (the SKU job's original mode);
    only meaningful on a stream in update mode."""
    return df.withColumn("proc_time", F.current_timestamp()).withColumn(WIN, F.window("proc_time", size))


# --------------------------------------------------------------------------
# J1 + J2: order detail fact on a change stream
# --------------------------------------------------------------------------

def order_detail_fact_stream(ods: DataFrame, lag: str = "5 seconds",
                             order_bound: tuple[str, str] = ("0 seconds", "30 minutes"),
                             link_bound: str = "10 seconds") -> DataFrame:
    """Detail inserts joined to their order insert (inner) and to the
    detail's activity and coupon (left outer), on a change stream.

    One watermark on the feed's event time ``et`` (set before the feed is
    split by table, so every change advances it). Every join carries a
    time range, so Spark can drop join state once the watermark passes it:
    a detail meets its order when ``od_et - oi_et`` lies in ``order_bound``
    (before, after), and an activity/coupon link when it is within
    ``link_bound`` of the detail. A left-joined row without a link is
    emitted once the range has passed the watermark (Q16: no retraction is
    ever needed). Output: the fact columns of ``facts.ORDER_DETAIL_COLS``.
    """
    from ..functions.dates import flexible_date
    from ..operators import cdc
    from ..operators.facts import ORDER_DETAIL_COLS
    w = ods.withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", lag)
    a = F.col("after")
    od = cdc.select_changes(w, "order_detail", "c").where(F.col("ts_ms").isNotNull()).select(
        a["id"].alias("id"), a["order_id"].alias("order_id"), a["sku_id"].alias("sku_id"),
        a["sku_name"].alias("sku_name"), a["create_time"].alias("create_time"), a["sku_num"].alias("sku_num"),
        (a["sku_num"].cast("decimal(16,2)") * a["order_price"].cast("decimal(16,2)")).cast("string")
        .alias("split_original_amount"),
        a["split_total_amount"].alias("split_total_amount"),
        a["split_activity_amount"].alias("split_activity_amount"),
        a["split_coupon_amount"].alias("split_coupon_amount"), "ts_ms", F.col("et").alias("od_et"))
    oi = cdc.select_changes(w, "order_info", "c").select(
        a["id"].alias("__oid"), a["user_id"].alias("user_id"), a["province_id"].alias("province_id"),
        F.col("et").alias("oi_et"))
    act = cdc.select_changes(w, "order_detail_activity", "c").select(
        a["order_detail_id"].alias("__aid"), a["activity_id"].alias("activity_id"),
        a["activity_rule_id"].alias("activity_rule_id"), F.col("et").alias("act_et"))
    cou = cdc.select_changes(w, "order_detail_coupon", "c").select(
        a["order_detail_id"].alias("__cid"), a["coupon_id"].alias("coupon_id"), F.col("et").alias("cou_et"))
    before, after = order_bound
    j = od.join(oi, F.expr(f"order_id = __oid AND od_et >= oi_et - INTERVAL {before} "
                           f"AND od_et <= oi_et + INTERVAL {after}"), "inner")
    j = j.join(act, F.expr(f"id = __aid AND act_et >= od_et - INTERVAL {link_bound} "
                           f"AND act_et <= od_et + INTERVAL {link_bound}"), "leftOuter")
    j = j.join(cou, F.expr(f"id = __cid AND cou_et >= od_et - INTERVAL {link_bound} "
                           f"AND cou_et <= od_et + INTERVAL {link_bound}"), "leftOuter")
    return j.withColumn("date_id", flexible_date("create_time")).select(*ORDER_DETAIL_COLS)


# --------------------------------------------------------------------------
# J3 / J4 / J10 on streams: time-bounded joins of the order-detail fact
# --------------------------------------------------------------------------

def _watermarked(ods: DataFrame, lag: str) -> DataFrame:
    return ods.withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", lag)


def order_cancel_fact_stream(detail: DataFrame, ods: DataFrame, lag: str = "5 seconds",
                             bound: str = "1805 seconds") -> DataFrame:
    """Detail facts (stream with ``et``) of orders cancelled 1001 -> 1003,
    within ``bound`` of each other (the original kept join state 1805 s)."""
    from ..functions.dates import flexible_date
    from ..operators import cdc
    from ..operators.facts import ORDER_CANCEL_COLS
    c = cdc.transitioned(cdc.select_changes(_watermarked(ods, lag), "order_info", "u"), "order_status",
                         "1001", "1003")
    c = c.select(F.col("after")["id"].alias("__oid"), F.col("after")["operate_time"].alias("cancel_time"),
                 F.col("ts_ms").alias("__cts"), F.col("et").alias("c_et"))
    d = detail.drop("date_id", "create_time", "ts_ms").withColumnRenamed("et", "d_et")
    j = d.join(c, F.expr(f"order_id = __oid AND d_et >= c_et - INTERVAL {bound} AND d_et <= c_et + INTERVAL {bound}"))
    return j.withColumn("date_id", flexible_date("cancel_time")).withColumnRenamed("__cts", "ts_ms") \
            .select(*ORDER_CANCEL_COLS)


def payment_fact_stream(detail: DataFrame, ods: DataFrame, dic: DataFrame, lag: str = "3 seconds",
                        interval: tuple[str, str] = ("30 minutes", "5 seconds"),
                        source_table: str = "refund_payment", status_col: str = "refund_status",
                        status: str = "1602") -> DataFrame:
    """J4 + J5: payments joined to detail facts (stream with ``et``) whose
    time lies in ``[pay_time - before, pay_time + after]`` -- the interval
    join; then the stream-static dictionary lookup."""
    from ..operators import cdc, dims
    from ..operators.facts import PAYMENT_COLS
    p = cdc.changed_to(cdc.select_changes(_watermarked(ods, lag), source_table, "u"), status_col, status)
    a = F.col("after")
    p = p.select(a["order_id"].alias("__poid"), a["payment_type"].alias("payment_type_code"),
                 a["callback_time"].alias("callback_time"), F.col("ts_ms").alias("__pts"), F.col("et").alias("p_et"))
    before, after = interval
    d = detail.drop("ts_ms").withColumnRenamed("et", "d_et")
    j = p.join(d, F.expr(f"order_id = __poid AND d_et >= p_et - INTERVAL {before} AND d_et <= p_et + INTERVAL {after}"))
    j = dims.dict_lookup(j, dic, "payment_type_code", "payment_type_name", "inner")
    return (j.withColumnRenamed("id", "order_detail_id").withColumnRenamed("split_total_amount", "split_payment_amount")
             .withColumnRenamed("__pts", "ts_ms").select(*PAYMENT_COLS))


def refund_fact_stream(ods: DataFrame, dic: DataFrame, lag: str = "5 seconds", bound: str = "5 seconds",
                       ops=("r", "c")) -> DataFrame:
    """Refund requests joined to orders moving to 1005 within ``bound``
    (the original's 5 s state limit, Q9), then two dictionary lookups."""
    from ..functions.dates import ms_to_date
    from ..operators import cdc, dims
    from ..operators.facts import REFUND_COLS
    w = _watermarked(ods, lag)
    ri = cdc.project(cdc.select_changes(w, "order_refund_info", ops),
                     {"id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
                      "refund_type_code": "refund_type", "refund_num": "refund_num",
                      "refund_amount": "refund_amount", "refund_reason_type_code": "refund_reason_type",
                      "refund_reason_txt": "refund_reason_txt", "create_time": "create_time"},
                     keep=["ts_ms", "et"]).withColumnRenamed("et", "r_et")
    oi = cdc.changed_to(cdc.select_changes(w, "order_info", "u"), "order_status", "1005")
    oi = oi.select(F.col("after")["id"].alias("__oid"), F.col("after")["province_id"].alias("province_id"),
                   F.col("et").alias("o_et"))
    j = ri.join(oi, F.expr(f"order_id = __oid AND r_et >= o_et - INTERVAL {bound} AND r_et <= o_et + INTERVAL {bound}"))
    j = dims.dict_lookup(j, dic, "refund_type_code", "refund_type_name", "inner")
    j = dims.dict_lookup(j, dic, "refund_reason_type_code", "refund_reason_type_name", "inner")
    return j.withColumn("date_id", ms_to_date(F.col("create_time").try_cast("bigint"))).select(*REFUND_COLS)


# --------------------------------------------------------------------------
# J8 / J9 with the config as a second stream
# --------------------------------------------------------------------------

CONFIG_COLS = ["sink_table", "sink_columns"]


def route_by_config_stream(ods: DataFrame, configs: DataFrame, preload: DataFrame, keys: str = "source_table, source_type",
                           columns=CONFIG_COLS, salts: int = 16) -> DataFrame:
    """J9 (``keys``: table and op) or J8 (table only) where ``configs`` is a
    stream of config changes (``op``, ``ts_ms``, the keys and ``columns``) and
    ``preload`` a table of the config as it was read at the start (S6), given to
    the processor as initial state. Output as ``routing.route_facts``:
    ``sink_table``, ``data`` (pruned image and ``ts_ms``); other ``columns`` follow.

    A source table may hold most of the records, so each key has ``salts`` parts:
    a record goes to the part of its image's hash, config changes and the
    preload to every part.
    """
    use_rocksdb_state(ods.sparkSession)
    names = [k.strip() for k in keys.split(",")]
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    data = F.to_json(F.map_concat(F.coalesce(cdc_image(), F.create_map().cast("map<string,string>")),
                                  F.create_map(F.lit("ts_ms"), F.col("ts_ms").cast("string"))))
    record = {"source_table": F.col("source")["table"], "source_type": F.col("op")}
    pos = F.col("pos") if "pos" in ods.columns else F.lit(0)
    records = ods.where(F.col("ts_ms").isNotNull() & record["source_table"].isNotNull()).select(
        F.concat_ws(":", *[record[n] for n in names]).alias("key"), data.alias("data"), "op", "ts_ms", F.coalesce(pos, F.lit(0)).cast("long").alias("pos"))
    records = records.select("key", F.pmod(F.xxhash64("data"), F.lit(salts)).cast("int").alias("salt"), F.lit("record").alias("kind"), "op", "ts_ms", "pos",
                             "data", *[F.lit(None).cast("string").alias(c) for c in columns])
    key = F.concat_ws(":", *names).alias("key")
    changes = configs.select(key, every, F.lit("config").alias("kind"), "op", F.col("ts_ms").cast("long"),
                             (F.col("pos") if "pos" in configs.columns else F.lit(0)).cast("long").alias("pos"),
                             F.lit(None).cast("string").alias("data"), *columns)
    both = records.unionByName(changes)
    start = preload.select(key, every, F.col("ts_ms").cast("long"), *columns)
    routed = both.groupBy("key", "salt").transformWithStateInPandas(
        ConfigRouter(list(columns)), both.schema, "Append", "None", initialState=start.groupBy("key", "salt"))
    kept = F.split(F.col("sink_columns"), ",")
    image = F.from_json("data", "map<string,string>")
    pruned = F.map_filter(image, lambda k, v: F.array_contains(kept, k) | (k == "ts_ms"))
    return routed.select("sink_table", pruned.alias("data"), *[c for c in columns if c not in CONFIG_COLS])


# --------------------------------------------------------------------------
# J3 / J10 with idle state retention
# --------------------------------------------------------------------------

def idle_join_stream(left: DataFrame, right: DataFrame, on: tuple[str, str], idle_ms: int, at: tuple[str, str] | None = None,
                     lag: str = "0 seconds", renew: bool = True) -> DataFrame:
    """Inner join of two streams on text keys whose rows are kept ``idle_ms``
    after their last use (T10), see ``IdleJoin``. ``at``: epoch-ms columns of the
    two sides, to measure idleness in event time; without them it is processing
    time. Columns of both sides follow each other; null keys join nothing."""
    use_rocksdb_state(left.sparkSession)
    sides = []
    for name, df, key, ms in (("l", left, on[0], at and at[0]), ("r", right, on[1], at and at[1])):
        time = F.col(ms).cast("long") if at else F.lit(0).cast("long")
        d = df.where(F.col(key).isNotNull()) if not at else df.where(F.col(key).isNotNull() & F.col(ms).isNotNull())
        sides.append(d.select(F.col(key).cast("string").alias("key"), F.lit(name).alias("side"), F.to_json(F.struct(*df.columns)).alias("body"), time.alias("at")))
    both = sides[0].unionByName(sides[1])
    if at:
        both = both.withColumn("et", F.timestamp_millis("at")).withWatermark("et", lag)
    joined = both.groupBy("key").transformWithStateInPandas(
        IdleJoin(idle_ms, bool(at), renew), "l string, r string", "Append", "EventTime" if at else "ProcessingTime")
    rows = joined.select(F.from_json("l", left.schema).alias("l"), F.from_json("r", right.schema).alias("r"))
    return rows.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in right.columns])


def order_cancel_fact_idle_stream(detail: DataFrame, ods: DataFrame, idle_ms: int = 1_805_000, event_time: bool = False) -> DataFrame:
    """J3 with the original's state rule: details and cancellations wait for
    each other 1805 s after their last use, however far apart their times are."""
    from ..functions.dates import flexible_date
    from ..operators import cdc
    from ..operators.facts import ORDER_CANCEL_COLS
    c = cdc.transitioned(cdc.select_changes(ods, "order_info", "u"), "order_status", "1001", "1003")
    c = c.select(F.col("after")["id"].alias("__oid"), F.col("after")["operate_time"].alias("cancel_time"), F.col("ts_ms").alias("__cts"))
    d = detail.withColumnRenamed("ts_ms", "__dts").drop("date_id", "create_time", "et")
    j = idle_join_stream(d, c, ("order_id", "__oid"), idle_ms, ("__dts", "__cts") if event_time else None)
    return j.withColumn("date_id", flexible_date("cancel_time")).withColumnRenamed("__cts", "ts_ms").select(*ORDER_CANCEL_COLS)


def refund_fact_idle_stream(ods: DataFrame, dic: DataFrame, idle_ms: int = 5_000, event_time: bool = False, ops=("r", "c")) -> DataFrame:
    """J10 with the original's state rule: 5 s after the last use (Q9)."""
    from ..functions.dates import ms_to_date
    from ..operators import cdc, dims
    from ..operators.facts import REFUND_COLS
    ri = cdc.project(cdc.select_changes(ods, "order_refund_info", ops),
                     {"id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
                      "refund_type_code": "refund_type", "refund_num": "refund_num",
                      "refund_amount": "refund_amount", "refund_reason_type_code": "refund_reason_type",
                      "refund_reason_txt": "refund_reason_txt", "create_time": "create_time"}, keep=["ts_ms"])
    oi = cdc.changed_to(cdc.select_changes(ods, "order_info", "u"), "order_status", "1005")
    oi = oi.select(F.col("after")["id"].alias("__oid"), F.col("after")["province_id"].alias("province_id"), F.col("ts_ms").alias("__ots"))
    j = idle_join_stream(ri, oi, ("order_id", "__oid"), idle_ms, ("ts_ms", "__ots") if event_time else None)
    j = dims.dict_lookup(j, dic, "refund_type_code", "refund_type_name", "inner")
    j = dims.dict_lookup(j, dic, "refund_reason_type_code", "refund_reason_type_name", "inner")
    return j.withColumn("date_id", ms_to_date(F.col("create_time").try_cast("bigint"))).select(*REFUND_COLS)
