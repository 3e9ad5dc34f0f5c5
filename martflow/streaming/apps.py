"""Stream applications: one function per warehouse job, wiring a source
topic through the operators to its sinks. Sources are topics
(``fmt='kafka'``) or folders of JSON-line files (``fmt='text'``).

Every application returns ``(main, dirty)``: the started query and a second one
that keeps the records that couldn't be parsed, as text under ``<out>_dirty``
(none is dropped). Options of all: ``checkpoint`` (else the folder
``spark.checkpoint.dir`` names; fixed per application, so a restarted job
resumes), ``trigger``, ``available_now``; applications with keyed state take
``ttl_ms``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import facts, logsplit, routing, text
from ..sources import cdc as cdc_src
from . import jobs, sinks


def _start(df: DataFrame, name: str, fn=None, path: str | None = None, fmt: str = "parquet",
           trigger: str | None = None, available_now: bool = False, checkpoint: str | None = None,
           mode: str = "append"):
    loc = f"{checkpoint.rstrip('/')}/{name}" if checkpoint else sinks._ckpt(df.sparkSession, name)
    w = df.writeStream.option("checkpointLocation", loc).outputMode(mode)
    if fn is not None:
        w = w.foreachBatch(fn)
    else:
        w = w.format(fmt).option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def _app(df: DataFrame, bad: DataFrame, name: str, out: str, fn=None, mode: str = "append", **kw):
    """``df`` to ``out`` (K5: the file sink writes each row once) or through
    ``fn``; ``bad`` (K10) to ``<out>_dirty``."""
    main = _start(df, name, fn=fn, path=None if fn else out, mode=mode, **kw)
    return main, _start(bad, f"{name}_dirty", path=f"{out}_dirty", fmt="text", **kw)


# --------------------------------------------------------------------------
# ODS ingest
# --------------------------------------------------------------------------

def cdc_ingest_app(values: DataFrame, out: str, **kw):
    """Change records of the shop database, checked and re-serialised as the
    single ODS topic (one folder of JSON lines; a Kafka topic through
    ``sinks.to_topic``)."""
    good, bad = cdc_src.parse_cdc(values)

    def write(batch, batch_id):
        cdc_src.to_topic_value(batch).write.mode("overwrite").text(f"{out}/{sinks.batch_folder(batch, batch_id)}")

    return _app(good, bad, "cdc_ingest", out, fn=write, **kw)


# --------------------------------------------------------------------------
# DWD log split
# --------------------------------------------------------------------------

def log_split_app(raw: DataFrame, out: str, lag: str = "3 seconds", ttl_ms: int | None = None, **kw):
    """Raw log stream -> dirty lines + five outputs. The new-visitor repair
    keeps its state across micro-batches (``transformWithState`` keyed by
    mid); the split itself is stateless and runs per micro-batch over the
    persisted batch, writing every output once."""
    logs, dirty = logsplit.parse_logs(raw)
    flat = logs.withColumn("rep_mid", F.col("common.mid")).withColumn("rep_sid", F.col("common.sid")) \
               .withColumn("rep_is_new", F.col("common.is_new")).withColumn("rep_ts", F.timestamp_millis("ts"))
    fixed = jobs.repair_is_new_stream(flat, "rep_mid", "rep_ts", ["rep_sid"], flag="rep_is_new", lag=lag, ttl_ms=ttl_ms)
    fixed = fixed.withColumn("common", F.col("common").withField("is_new", F.col("rep_is_new"))) \
                 .drop("rep_mid", "rep_sid", "rep_is_new", "rep_ts")

    def write(batch, batch_id):
        batch.persist()
        try:
            for name, df in logsplit.split_records(batch).items():
                logsplit.to_json_lines(df).write.mode("overwrite").text(f"{out}/{name}/{sinks.batch_folder(batch, batch_id)}")
        finally:
            batch.unpersist()

    return _app(fixed, dirty, "log_split", out, fn=write, **kw)


# --------------------------------------------------------------------------
# DIM sync (J8, P5, K6, K7, T8, T9)
# --------------------------------------------------------------------------

def dim_sync_app(ods_values: DataFrame, config_reader, out: str, db: str | None = None, **kw):
    """Change feed -> dimension tables. Each micro-batch re-reads the current
    routing config (``config_reader()`` returns the config change feed, so a
    config change applies from the next batch -- the broadcast-state update
    of the original), routes, and appends the batch's fold state. The state
    keeps each cell's change time, so changes of a row may arrive in any order
    and in any batch. Read the visible rows with :func:`dim_table`."""
    ods, bad = cdc_src.parse_cdc(ods_values)

    def write(batch, batch_id):
        sinks.append_changes(routing.dim_cells(routing.route_dims(batch, config_reader(), db)), batch_id, out)

    return _app(ods, bad, "dim_sync", out, fn=write, **kw)


def dim_table(spark, out: str) -> DataFrame:
    """The dimension rows that :func:`dim_sync_app` has stored."""
    return routing.dim_rows(routing.merge_cells(sinks.read_changes(spark, out)))


# --------------------------------------------------------------------------
# DWD base-db routing
# --------------------------------------------------------------------------

def fact_route_app(ods_values: DataFrame, config_reader, out: str, **kw):
    """Change feed -> one folder (topic) per configured sink table."""
    ods, bad = cdc_src.parse_cdc(ods_values)

    def write(batch, batch_id):
        # One folder per run, batch and sink table (topic): a retried batch
        # replaces its own.
        r = routing.route_facts(batch, config_reader())
        r.withColumn("data", F.to_json("data")).write.mode("overwrite").partitionBy("sink_table") \
            .json(f"{out}/{sinks.batch_folder(batch, batch_id)}")

    return _app(ods, bad, "fact_route", out, fn=write, **kw)


# --------------------------------------------------------------------------
# DWD facts. Rows are appended as changes; replays are folded by the reader
# (``sinks.read_upsert_table``) or by the downstream dedup.
# --------------------------------------------------------------------------

def cart_add_app(ods_values: DataFrame, out: str, **kw):
    ods, bad = cdc_src.parse_cdc(ods_values)
    rows = facts.cart_add_rows(ods).withColumnRenamed("ts_ms", "ts")
    return _app(rows, bad, "cart_add", out, **kw)


def comment_app(ods_values: DataFrame, dic: DataFrame, out: str, **kw):
    """Stream-static lookup join to the dictionary."""
    ods, bad = cdc_src.parse_cdc(ods_values)
    return _app(facts.named_comments(facts.comment_rows(ods), dic), bad, "comment", out, **kw)


def order_detail_app(ods_values: DataFrame, out: str, lag: str = "5 seconds", order_bound=("0 seconds", "30 minutes"),
                     link_bound: str = "10 seconds", **kw):
    """J1 + J2: detail, order, activity and coupon inserts as one fact."""
    ods, bad = cdc_src.parse_cdc(ods_values)
    return _app(jobs.order_detail_fact_stream(ods, lag, order_bound, link_bound), bad, "order_detail", out, **kw)


def _details(detail_values: DataFrame, lag: str | None):
    return cdc_src.fact_topic_table(detail_values, facts.ORDER_DETAIL_COLS, lag)


def order_cancel_app(detail_values: DataFrame, ods_values: DataFrame, out: str, lag: str = "5 seconds",
                     bound: str = "1805 seconds", **kw):
    """The order-detail topic joined to cancellations of the change feed."""
    details, bad = _details(detail_values, lag)
    ods, bad_ods = cdc_src.parse_cdc(ods_values)
    return _app(jobs.order_cancel_fact_stream(details, ods, lag, bound), bad.unionByName(bad_ods), "order_cancel", out, **kw)


def payment_app(detail_values: DataFrame, ods_values: DataFrame, dic: DataFrame, out: str, lag: str = "3 seconds",
                interval=("30 minutes", "5 seconds"), **kw):
    """J4 + J5: payments joined to the order-detail topic in a time interval."""
    details, bad = _details(detail_values, lag)
    ods, bad_ods = cdc_src.parse_cdc(ods_values)
    return _app(jobs.payment_fact_stream(details, ods, dic, lag, interval), bad.unionByName(bad_ods), "payment", out, **kw)


def refund_app(ods_values: DataFrame, dic: DataFrame, out: str, lag: str = "5 seconds", bound: str = "5 seconds", **kw):
    """Refund requests joined to orders that moved to refunding."""
    ods, bad = cdc_src.parse_cdc(ods_values)
    return _app(jobs.refund_fact_stream(ods, dic, lag, bound), bad, "refund", out, **kw)


# --------------------------------------------------------------------------
# DWS windows
# --------------------------------------------------------------------------

def _pages(page_values: DataFrame, lag: str | None):
    pages, bad = cdc_src.page_topic_table(page_values, lag=lag)
    # tie-breaker within a visitor and millisecond: the record itself
    return pages.withColumn("event_id", F.xxhash64(*[c for c in pages.columns if c != "ts"])), bad


def traffic_app(page_values: DataFrame, out: str, size: str = "10 seconds", lag: str = "1 second",
                ttl_ms: int | None = None, **kw):
    """Page topic -> page views per window by version/channel/area/is_new."""
    pages, bad = _pages(page_values, None)
    return _app(jobs.traffic_window_stream(pages, size, lag, ttl_ms), bad, "traffic", out, **kw)


def home_detail_app(page_values: DataFrame, out: str, size: str = "3 seconds", lag: str = "3 seconds",
                    ttl_ms: int | None = None, **kw):
    """Page topic -> daily unique home and detail visitors per window."""
    pages, bad = _pages(page_values, None)
    return _app(jobs.home_detail_window_stream(pages, size, lag, ttl_ms), bad, "home_detail", out, **kw)


def login_app(page_values: DataFrame, out: str, size: str = "3 hours", back_days: int = 8, lag: str = "0 seconds",
              ttl_ms: int | None = None, **kw):
    """Page topic -> daily users and returning users per window."""
    pages, bad = _pages(page_values, None)
    return _app(jobs.login_window_stream(pages, size, back_days, lag, ttl_ms), bad, "login", out, **kw)


def cart_users_app(cart_values: DataFrame, out: str, size: str = "5 seconds", lag: str = "0 seconds",
                   ttl_ms: int | None = None, **kw):
    """Cart-add topic -> users adding for the first time of the day per window."""
    rows, bad = cdc_src.fact_topic_table(cart_values, ["id", "user_id", "sku_id", "sku_num", "ts_ms"])
    return _app(jobs.cart_uu_window_stream(rows, size, "et", lag, ttl_ms), bad, "cart_users", out, **kw)


def _upsert_windows(out: str):
    """Windows in update mode: each batch's rows are changes of the result
    table, ordered by batch; read with :func:`window_table`."""

    def write(batch, batch_id):
        # batches are ordered in a run, and runs by when they wrote
        at = F.struct(F.current_timestamp().alias("at"), F.lit(batch_id).alias("batch"))
        sinks.append_changes(batch.withColumn("version", at), batch_id, out)
    return write


def window_table(spark, out: str, keys: list[str]) -> DataFrame:
    return sinks.read_upsert_table(spark, out, keys, ["version"]).drop("version")


PROVINCE_KEYS, SKU_KEYS = ["stt", "province_id"], ["stt", "sku_id"]


def province_app(detail_values: DataFrame, provinces: DataFrame, out: str, size: str = "2 seconds", lag: str = "0 seconds",
                 ttl_ms: int | None = None, **kw):
    """Order-detail topic -> orders and amounts per window and province."""
    details, bad = _details(detail_values, None)
    df = jobs.province_window_stream(details, provinces, ["ts_ms"], size, lag, ttl_ms)
    return _app(df, bad, "province", out, fn=_upsert_windows(out), mode="update", **kw)


def sku_app(detail_values: DataFrame, wide_sku: DataFrame, out: str, size: str = "10 seconds", lag: str = "0 seconds",
            processing_time: bool = False, ttl_ms: int | None = None, **kw):
    """Order-detail topic -> the four amounts per window and SKU."""
    details, bad = _details(detail_values, None)
    df = jobs.sku_window_stream(details, wide_sku, ["ts_ms"], size, lag, processing_time, ttl_ms)
    return _app(df, bad, "sku", out, fn=_upsert_windows(out), mode="update", **kw)


def keyword_app(page_values: DataFrame, texts: DataFrame, out: str, size: str = "1 second", **kw):
    """Page topic -> search keywords per window. The texts are tokenised once,
    when the application starts, into ``<out>_terms``; batches join that table."""
    pages, bad = cdc_src.page_topic_table(page_values, lag="0 seconds")
    terms = f"{out}_terms"
    text.keyword_counts_per_text(texts.select(F.col("doc_id").cast("string").alias("ref"), "text"), "ref", "text") \
        .write.mode("overwrite").parquet(terms)
    searches = text.search_rows(pages).select(F.col("ts").alias("et"), F.col("item").alias("ref"))
    kws = searches.join(texts.sparkSession.read.parquet(terms), "ref").select("et", "keyword", "cnt")
    return _app(jobs.keyword_window_stream(kws, size, lag=None), bad, "keywords", out, **kw)
