"""Stream applications end to end on JSON-line topic folders (availableNow)."""

import os

import pytest
from pyspark.sql import functions as F


from martflow.operators import cdc as cdc_ops
from martflow.operators import logsplit, routing
from martflow.sources import applog, cdc as cdc_src, config, retail
from martflow.sources.tables import Tables
from martflow.streaming import apps, jobs, sinks  # noqa: F401

SF = "/root/testdata/sf0.001"


def topic_dir(df, path, parts=3):
    """Write a text topic as a few files with increasing mtimes (one file
    keeps the input's order)."""
    (df.coalesce(1) if parts == 1 else df.repartition(parts)).write.text(path)
    for i, f in enumerate(sorted(x for x in os.listdir(path) if x.startswith("part-"))):
        os.utime(f"{path}/{f}", (1_000_000 + i, 1_000_000 + i))


def test_log_split_app_matches_batch(spark, scratch):
    jobs.use_rocksdb_state(spark)
    raw = applog.app_log_text(Tables(spark, SF)).checkpoint()
    topic_dir(raw, f"{scratch}/logs", parts=1)
    s = spark.readStream.format("text").load(f"{scratch}/logs")
    q1, q2 = apps.log_split_app(s, f"{scratch}/out", available_now=True, checkpoint=f"{scratch}/ckpt")
    q1.awaitTermination(300)
    q2.awaitTermination(300)
    batch = logsplit.split_log(raw)
    for name in ["page", "start", "err", "display", "action"]:
        got = spark.read.text(f"{scratch}/out/{name}").count()
        assert got == batch[name].count(), name
    assert spark.read.text(f"{scratch}/out_dirty").count() == batch["dirty"].count()
    # the repaired flag survives the stream
    got = {r.sid: r.is_new for r in spark.read.json(f"{scratch}/out/page")
           .select("common.sid", "common.is_new").collect()}
    want = {r.sid: r.is_new for r in batch["page"].select("common.sid", "common.is_new").collect()}
    assert got == want


def test_dim_sync_app_matches_batch(spark, scratch):
    t = Tables(spark, SF)
    feed = retail.dim_ods(t)
    topic_dir(cdc_src.to_topic_value(feed), f"{scratch}/ods", parts=3)
    s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/ods")
    for q in apps.dim_sync_app(s, lambda: config.dim_config_feed(spark), f"{scratch}/dims", available_now=True,
                               checkpoint=f"{scratch}/ckpt"):
        q.awaitTermination(300)
    got = sorted(tuple(r) for r in apps.dim_table(spark, f"{scratch}/dims").collect())
    want = sorted(tuple(r) for r in routing.fold_routed_dims(
        routing.route_dims(feed, config.dim_config_feed(spark))).collect())
    assert got == want and len(got) > 0
    # compacted: the same rows from a base and the batches after it
    sinks.compact(spark, f"{scratch}/dims", routing.merge_cells)
    assert sorted(tuple(r) for r in apps.dim_table(spark, f"{scratch}/dims").collect()) == want


def test_order_detail_fact_stream_equals_batch_versions(spark, scratch):
    """J1 + J2 as stream-stream joins. In the derived feed the change times
    of an order, its lines and their links are years apart (order date vs
    ship dates), so the test bounds are wide. A sentinel change far in the
    future moves the watermark so every pending outer row is emitted."""
    from martflow.operators import facts
    from martflow.plans.catalog import DETAIL_FEEDS
    t = Tables(spark, SF)
    # orders and links without replays: a stream join meets every version
    ods = retail.ods(t, ["order_detail"]).unionByName(cdc_ops.compacted(retail.ods(t, DETAIL_FEEDS[1:])))
    sentinel = spark.createDataFrame(
        [(None, {"id": "x"}, {"db": "stream_retail", "table": "order_info"}, "c", 4102444800000, 0)],
        ods.schema)
    topic_dir(cdc_src.to_topic_value(ods), f"{scratch}/ods/a", parts=1)
    topic_dir(cdc_src.to_topic_value(sentinel), f"{scratch}/ods/b", parts=1)
    for f in os.listdir(f"{scratch}/ods/b"):
        os.utime(f"{scratch}/ods/b/{f}", (5_000_000, 5_000_000))
    os.makedirs(f"{scratch}/topic")
    for d in ["a", "b"]:
        for f in os.listdir(f"{scratch}/ods/{d}"):
            if f.startswith("part-"):
                st = os.stat(f"{scratch}/ods/{d}/{f}")
                os.link(f"{scratch}/ods/{d}/{f}", f"{scratch}/topic/{d}_{f}")
                os.utime(f"{scratch}/topic/{d}_{f}", (st.st_mtime, st.st_mtime))
    s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/topic")
    good, _ = cdc_src.parse_cdc(s)
    fact = jobs.order_detail_fact_stream(good, lag="0 seconds", order_bound=("3650 days", "3650 days"),
                                         link_bound="3650 days")
    q = (fact.writeStream.format("memory").queryName("od_stream").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt_od").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("od_stream").collect())
    want = sorted(tuple(r) for r in facts.order_detail_versions(ods).drop("replay_order").collect())
    assert got == want and len(got) > 0


def test_refund_fact_stream_equals_batch(spark, scratch):
    """J10 on a stream with a wide bound (refund and order changes of the
    derived feed are years apart) equals the batch fact."""
    from martflow.operators import facts
    t = Tables(spark, SF)
    ods = cdc_ops.compacted(retail.ods(t, ["order_refund_info", "order_info"]))
    topic_dir(cdc_src.to_topic_value(ods), f"{scratch}/topic", parts=2)
    s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/topic")
    good, _ = cdc_src.parse_cdc(s)
    fact = jobs.refund_fact_stream(good, retail.base_dic(spark), lag="3650 days", bound="3650 days")
    q = (fact.writeStream.format("memory").queryName("refund_stream").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt_refund").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("refund_stream").collect())
    want = sorted(tuple(r) for r in facts.refund_fact(ods, retail.base_dic(spark)).collect())
    assert got == want and len(got) > 0


def _stream_of_feed(spark, df, path, parts=2):
    topic_dir(cdc_src.to_topic_value(df), path, parts=parts)
    s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(path)
    return cdc_src.parse_cdc(s)[0]


def _collect_stream(spark, df, name, scratch):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt_{name}").start())
    q.processAllAvailable()
    q.stop()
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_cancel_and_payment_streams_equal_batch(spark, scratch):
    """J3 and J4 on streams over a static-sized detail table turned into a
    stream, with bounds wide enough for the derived feed's time gaps."""
    from martflow.operators import facts
    from martflow.plans.catalog import DETAIL_FEEDS
    t = Tables(spark, SF)
    detail = facts.order_detail_fact(retail.ods(t, DETAIL_FEEDS))
    detail.write.parquet(f"{scratch}/detail")
    d_stream = spark.readStream.schema(detail.schema).parquet(f"{scratch}/detail") \
                    .withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", "3650 days")
    oi = cdc_ops.compacted(retail.ods(t, ["order_info"]))
    cancel = jobs.order_cancel_fact_stream(d_stream, _stream_of_feed(spark, oi, f"{scratch}/oi"),
                                           lag="3650 days", bound="3650 days")
    got = _collect_stream(spark, cancel, "cancel_stream", scratch)
    want = sorted(tuple(r) for r in facts.order_cancel_fact(detail, oi).collect())
    assert got == want and len(got) > 0
    pay = cdc_ops.compacted(retail.ods(t, ["refund_payment"]))
    d_stream2 = spark.readStream.schema(detail.schema).parquet(f"{scratch}/detail") \
                     .withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", "3650 days")
    pstream = jobs.payment_fact_stream(d_stream2, _stream_of_feed(spark, pay, f"{scratch}/pay"),
                                       retail.base_dic(spark), lag="3650 days",
                                       interval=("3650 days", "3650 days"))
    got = _collect_stream(spark, pstream, "pay_stream", scratch)
    want = sorted(tuple(r) for r in facts.payment_fact(detail, pay, retail.base_dic(spark)).collect())
    assert got == want and len(got) > 0


def test_province_window_stream_amounts_equal_batch(spark, scratch):
    """T6 + A6 on a stream: per-window amounts of the +/- rows equal the
    batch (last version per id) wherever the batch has the window; other
    stream windows only held superseded versions and sum to zero (Q15)."""
    from decimal import Decimal
    from martflow.operators import facts, windows
    from martflow.plans.catalog import DETAIL_FEEDS
    t = Tables(spark, SF)
    ods = retail.ods(t, DETAIL_FEEDS)
    v = facts.order_detail_versions(ods)
    order = [f"k{i}" for i in range(7)]
    flat = v.select("*", *[F.col("replay_order")[k].alias(k) for k in order]).drop("replay_order")
    # Arrival order must follow the replay order (the retraction is
    # arrival-ordered, like the original): range-split files, oldest first.
    flat.repartitionByRange(3, *order).write.parquet(f"{scratch}/versions")
    parts = sorted(f for f in os.listdir(f"{scratch}/versions") if f.startswith("part-"))
    for i, f in enumerate(parts):
        os.utime(f"{scratch}/versions/{f}", (1_000_000 + i, 1_000_000 + i))
    s = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/versions") \
             .withColumn("et", F.timestamp_millis("ts_ms"))
    out = jobs.province_window_stream(s, retail.province_dim(t), order, "1 day", lag="36500 days")
    q = (out.writeStream.format("memory").queryName("prov_stream").outputMode("update")
         .option("checkpointLocation", f"{scratch}/ckpt_prov").start())
    q.processAllAvailable()
    q.stop()
    # update mode: keep the last emitted value per window and province
    got = {}
    for r in spark.table("prov_stream").collect():
        got[(r.stt, r.province_id)] = r.order_amount
    want = {(r.stt, r.province_id): r.order_amount
            for r in windows.province_window(facts.order_detail_fact(ods), retail.province_dim(t), "1 day",
                                             deduped=True).collect()}
    assert len(want) > 0
    for k, amt in want.items():
        assert got[k] == amt, k
    assert all(v_ == Decimal("0") for k, v_ in got.items() if k not in want)


def test_sku_window_stream_amounts_equal_batch(spark, scratch):
    """T6 + A5 + J7 on a stream vs the batch SKU window (same rules as the
    province test: arrival follows replay order, superseded-only windows
    sum to zero)."""
    from decimal import Decimal
    from martflow.operators import dims, facts, windows
    from martflow.plans.catalog import DETAIL_FEEDS
    t = Tables(spark, SF)
    ods = retail.ods(t, DETAIL_FEEDS)
    order = [f"k{i}" for i in range(7)]
    flat = facts.order_detail_versions(ods)
    flat = flat.select("*", *[F.col("replay_order")[k].alias(k) for k in order]).drop("replay_order")
    flat.repartitionByRange(3, *order).write.parquet(f"{scratch}/v")
    for i, f in enumerate(sorted(f for f in os.listdir(f"{scratch}/v") if f.startswith("part-"))):
        os.utime(f"{scratch}/v/{f}", (1_000_000 + i, 1_000_000 + i))
    s = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/v") \
             .withColumn("et", F.timestamp_millis("ts_ms"))
    wide = dims.wide_sku_dim(retail.sku_dims(t))
    out = jobs.sku_window_stream(s, wide, order, "1 day", lag="36500 days")
    q = (out.writeStream.format("memory").queryName("sku_stream").outputMode("update")
         .option("checkpointLocation", f"{scratch}/ckpt_sku").start())
    q.processAllAvailable()
    q.stop()
    got = {}
    for r in spark.table("sku_stream").collect():
        got[(r.stt, r.sku_id)] = (r.original_amount, r.order_amount, r.sku_name)
    want = {(r.stt, r.sku_id): (r.original_amount, r.order_amount, r.sku_name)
            for r in windows.sku_window(facts.order_detail_fact(ods), wide, "1 day", deduped=True).collect()}
    assert len(want) > 0
    for k, v_ in want.items():
        assert got[k] == v_, k
    assert all(v_[1] == Decimal("0") for k, v_ in got.items() if k not in want)


def _run_app(queries):
    """Drain every query, then stop it."""
    for q in queries:
        q.processAllAvailable()
    for q in queries:
        q.stop()
        q.awaitTermination(60)


def test_simple_fact_apps_equal_batch(spark, scratch):
    """cart-add, comment and config-routed facts as stream apps."""
    from martflow.operators import facts
    t = Tables(spark, SF)
    ods = retail.ods(t, ["cart_info", "comment_info", "refund_payment"])
    topic_dir(cdc_src.to_topic_value(ods), f"{scratch}/ods", parts=3)
    src = lambda: spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/ods")
    ck = f"{scratch}/ckpt"
    _run_app(apps.cart_add_app(src(), f"{scratch}/cart", checkpoint=ck))
    _run_app(apps.comment_app(src(), retail.base_dic(spark), f"{scratch}/comment", checkpoint=ck))
    _run_app(apps.fact_route_app(src(), lambda: config.fact_config_feed(spark), f"{scratch}/route", checkpoint=ck))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/cart").collect())
    assert got == sorted(tuple(r) for r in facts.cart_add_rows(ods).withColumnRenamed("ts_ms", "ts").collect())
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/comment").collect())
    assert got == sorted(tuple(r) for r in facts.named_comments(facts.comment_rows(ods), retail.base_dic(spark)).collect())
    routed = spark.read.json(f"{scratch}/route")
    want = routing.route_facts(ods, config.fact_config_feed(spark))
    assert sorted((r.sink_table, r.data) for r in routed.select("sink_table", "data").collect()) == \
        sorted((r.sink_table, r.data) for r in want.select("sink_table", F.to_json("data").alias("data")).collect())


def test_traffic_app_on_page_topic(spark, scratch):
    """Page topic (the log split's page output as JSON lines) -> traffic
    windows, equal to the batch window over the same page records."""
    from martflow.operators import windows
    raw = applog.app_log_text(Tables(spark, SF)).checkpoint()
    pages = logsplit.to_json_lines(logsplit.split_log(raw)["page"])
    sentinel = spark.createDataFrame(
        [('{"common":{"mid":"zz","vc":"v","ch":"c","ar":"a","is_new":"0"},"page":{"page_id":"home"},'
          '"ts":4102444800000}',)], "value string")
    topic_dir(pages.orderBy(F.get_json_object("value", "$.ts").cast("long")), f"{scratch}/pages", parts=1)
    topic_dir(sentinel, f"{scratch}/pages_s", parts=1)
    for f in os.listdir(f"{scratch}/pages_s"):
        if f.startswith("part-"):
            os.link(f"{scratch}/pages_s/{f}", f"{scratch}/pages/zz_{f}")
            os.utime(f"{scratch}/pages/zz_{f}", (9_000_000, 9_000_000))
    s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/pages")
    _run_app(apps.traffic_app(s, f"{scratch}/traffic", size="1 hour", checkpoint=f"{scratch}/ckpt"))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/traffic").collect())
    flat = cdc_src.page_topic_table(pages, lag=None)[0].withColumn("event_id", F.col("ts_ms"))
    want = sorted(tuple(r) for r in windows.traffic_window(flat, "1 hour").collect())
    assert got == want and len(got) > 0


def test_keyword_app_on_page_topic(spark, scratch):
    """Search pages of the page topic -> keyword counts per window, the
    search texts looked up in the documents table (stream-static join)."""
    from martflow.operators import text as text_ops, windows
    t = Tables(spark, SF)
    raw = applog.app_log_text(t).checkpoint()
    pages = logsplit.to_json_lines(logsplit.split_log(raw)["page"])
    sentinel = spark.createDataFrame(
        [('{"common":{"mid":"zz"},"page":{"page_id":"x","last_page_id":"search","item_type":"keyword",'
          '"item":"0"},"ts":4102444800000}',)], "value string")
    topic_dir(pages.unionByName(sentinel).orderBy(F.get_json_object("value", "$.ts").cast("long")),
              f"{scratch}/pages", parts=1)
    s = spark.readStream.format("text").load(f"{scratch}/pages")
    _run_app(apps.keyword_app(s, t.documents, f"{scratch}/kw", size="1 day", checkpoint=f"{scratch}/ckpt"))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/kw").collect())
    flat = cdc_src.page_topic_table(pages, lag=None)[0]
    want = sorted(tuple(r) for r in windows.keyword_counts(
        text_ops.search_keywords(text_ops.search_rows(flat), t.documents), "1 day").collect())
    assert got == want and len(got) > 0


# -- every application keeps what it can't parse --------------------------------

PAGE = '{"common":{"mid":"m1","uid":"u1","vc":"v","ch":"c","ar":"a","is_new":"1"},"page":{"page_id":"home","last_page_id":"login"},"ts":%d}'
DETAIL = '{"id":"%s","order_id":"%s","sku_id":"1","province_id":"2","split_original_amount":"5.00","split_activity_amount":"0","split_coupon_amount":"0","split_total_amount":"%s","ts_ms":%d}'
T0 = 1_700_000_000_000
END = 4_102_444_800_000


def _lines(spark, path, lines):
    os.makedirs(path)
    for i, part in enumerate(lines):
        with open(f"{path}/part-{i}", "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(f"{path}/part-{i}", (1_000_000 + i, 1_000_000 + i))
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(path)


def _cdc(table, op, after, ts, before=None, pos=0):
    import json
    return json.dumps({"before": before, "after": after, "source": {"db": "stream_retail", "table": table}, "op": op, "ts_ms": ts, "pos": pos})


def test_apps_divert_bad_records(spark, scratch):
    jobs.use_rocksdb_state(spark)
    bad = ["no json", '{"cut off": ']
    t = Tables(spark, SF)
    dic, conf = retail.base_dic(spark), config
    feed = [[_cdc("cart_info", "c", {"id": "1", "user_id": "u", "sku_num": "2"}, T0), *bad],
            [_cdc("comment_info", "r", {"id": "1", "appraise": "1201"}, T0)]]
    pages = [[PAGE % T0, *bad], [PAGE % END]]
    details = [[DETAIL % ("1", "1", "5.00", T0), *bad], [DETAIL % ("2", "2", "7.00", T0 + 1000)]]
    carts = [['{"id":"1","user_id":"u","sku_num":"2","ts_ms":%d}' % T0, *bad], ['{"id":"2","user_id":"v","sku_num":"2","ts_ms":%d}' % END]]
    texts = t.documents
    runs = {
        "ingest": (feed, lambda s, o, k: apps.cdc_ingest_app(s, o, **k)),
        "dims": (feed, lambda s, o, k: apps.dim_sync_app(s, lambda: conf.dim_config_feed(spark), o, **k)),
        "route": (feed, lambda s, o, k: apps.fact_route_app(s, lambda: conf.fact_config_feed(spark), o, **k)),
        "cart": (feed, lambda s, o, k: apps.cart_add_app(s, o, **k)),
        "comment": (feed, lambda s, o, k: apps.comment_app(s, dic, o, **k)),
        "order_detail": (feed, lambda s, o, k: apps.order_detail_app(s, o, **k)),
        "refund": (feed, lambda s, o, k: apps.refund_app(s, dic, o, **k)),
        "traffic": (pages, lambda s, o, k: apps.traffic_app(s, o, **k)),
        "home_detail": (pages, lambda s, o, k: apps.home_detail_app(s, o, **k)),
        "login": (pages, lambda s, o, k: apps.login_app(s, o, **k)),
        "keyword": (pages, lambda s, o, k: apps.keyword_app(s, texts, o, **k)),
        "cart_users": (carts, lambda s, o, k: apps.cart_users_app(s, o, **k)),
        "province": (details, lambda s, o, k: apps.province_app(s, retail.province_dim(t), o, lag="1 day", **k)),
        "sku": (details, lambda s, o, k: apps.sku_app(s, __import__("martflow.operators.dims", fromlist=["x"]).wide_sku_dim(retail.sku_dims(t)), o, lag="1 day", **k)),
    }
    for name, (lines, start) in runs.items():
        s = _lines(spark, f"{scratch}/{name}_in", lines)
        _run_app(start(s, f"{scratch}/{name}", {"checkpoint": f"{scratch}/ckpt"}))
        assert sorted(r.value for r in spark.read.text(f"{scratch}/{name}_dirty").collect()) == sorted(bad), name
    assert spark.read.parquet(f"{scratch}/login").count() == 1
    assert spark.read.parquet(f"{scratch}/home_detail").count() == 1
    assert spark.read.parquet(f"{scratch}/cart_users").count() == 1
    assert spark.read.text(f"{scratch}/ingest").count() == 2
    rows = apps.window_table(spark, f"{scratch}/province", apps.PROVINCE_KEYS).collect()
    assert sum(r.order_amount for r in rows) == 12
    rows = apps.window_table(spark, f"{scratch}/sku", apps.SKU_KEYS).collect()
    assert sum(r.order_amount for r in rows) == 12


def test_cancel_and_payment_apps(spark, scratch):
    detail = [[DETAIL % ("d1", "o1", "5.00", T0), "no detail"]]
    feed = [[_cdc("order_info", "u", {"id": "o1", "order_status": "1003", "operate_time": str(T0)}, T0 + 60_000, {"order_status": "1001"}),
             _cdc("refund_payment", "u", {"id": "p", "order_id": "o1", "payment_type": "1101", "callback_time": "x", "refund_status": "1602"},
                  T0 + 60_000, {"refund_status": "1601"}), "no change"]]
    for name, start in {
        "cancel": lambda d, s, o, k: apps.order_cancel_app(d, s, o, **k),
        "payment": lambda d, s, o, k: apps.payment_app(d, s, retail.base_dic(spark), o, **k),
    }.items():
        d, s = _lines(spark, f"{scratch}/{name}_d", detail), _lines(spark, f"{scratch}/{name}_s", feed)
        _run_app(start(d, s, f"{scratch}/{name}", {"checkpoint": f"{scratch}/ckpt"}))
        assert spark.read.parquet(f"{scratch}/{name}").count() == 1
        assert sorted(r.value for r in spark.read.text(f"{scratch}/{name}_dirty").collect()) == ["no change", "no detail"]
