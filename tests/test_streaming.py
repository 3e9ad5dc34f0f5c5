"""Streams replay the same rows as the batch functions and must agree.

Rows are written as one parquet file per day with increasing modification
times (the file source orders by mtime) and read one file per micro-batch,
so keyed state carries across batches. A final sentinel file far in the
future moves the watermark past every real window.
"""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martflow.operators import state, windows
from martflow.sources import retail
from martflow.sources.tables import Tables
from martflow.streaming import jobs, sinks

SF = "/root/testdata/sf0.001"


def write_days(df, ts, base):
    """One parquet folder per day, mtimes increasing with the day."""
    days = sorted(r.d for r in df.select(F.date_format(ts, "yyyyMMdd").alias("d")).distinct().collect())
    for i, d in enumerate(days):
        p = f"{base}/part_{i:04d}"
        df.where(F.date_format(ts, "yyyyMMdd") == d).coalesce(1).write.parquet(p)
        for f in os.listdir(p):
            os.utime(f"{p}/{f}", (1_000_000 + i, 1_000_000 + i))
    return days


def flat_files(base, out):
    """Move per-day files into one folder (the file stream reads one level)."""
    os.makedirs(out, exist_ok=True)
    for d in sorted(os.listdir(base)):
        for f in os.listdir(f"{base}/{d}"):
            if f.endswith(".parquet"):
                st = os.stat(f"{base}/{d}/{f}")
                os.link(f"{base}/{d}/{f}", f"{out}/{d}_{f}")
                os.utime(f"{out}/{d}_{f}", (st.st_mtime, st.st_mtime))


def run_stream(spark, df, name, scratch):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt_{name}").start())
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


@pytest.fixture(scope="module")
def page_files(spark, tmp_path_factory):
    jobs.use_rocksdb_state(spark)
    base = str(tmp_path_factory.mktemp("pages"))
    pl = retail.page_log(Tables(spark, SF)).select(
        "event_id", "ts", "mid", "uid", "vc", "ch", "ar", "is_new", "page_id", "last_page_id", "during_time")
    write_days(pl, "ts", f"{base}/days")
    sentinel = pl.limit(1).withColumn("ts", F.to_timestamp(F.lit("2030-01-01 00:00:00"))) \
                 .withColumn("mid", F.lit("sentinel")).withColumn("event_id", F.lit(-1).cast("long")) \
                 .withColumn("uid", F.lit("sentinel")).withColumn("last_page_id", F.lit("login"))
    # The sentinel passes every filter: downstream of a stateful step event
    # time only advances with rows that step emits.
    p = f"{base}/days/part_9999"
    sentinel.coalesce(1).write.parquet(p)
    for f in os.listdir(p):
        os.utime(f"{p}/{f}", (2_000_000, 2_000_000))
    flat_files(f"{base}/days", f"{base}/flat")
    return f"{base}/flat", pl.schema, pl


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(path)


def test_first_of_day_stream_equals_batch(spark, page_files, scratch):
    path, schema, pl = page_files
    s = stream_of(spark, path, schema).select("mid", "ts", "event_id")
    out = run_stream(spark, jobs.first_of_day_stream(s, "mid", "ts", ["event_id"], "flag", "uv_ct"), "fod", scratch)
    got = {(r.event_id, r.uv_ct) for r in out.where("event_id >= 0").collect()}
    want = {(r.event_id, r.uv_ct) for r in
            state.flag_first_of_day(pl.select("mid", "ts", "event_id"), "mid", "ts", ["event_id"]).collect()}
    assert got == want


def test_traffic_window_stream_equals_batch(spark, page_files, scratch):
    path, schema, pl = page_files
    out = run_stream(spark, jobs.traffic_window_stream(stream_of(spark, path, schema), "1 hour"), "traffic", scratch)
    got = sorted(tuple(r) for r in out.collect())
    want = sorted(tuple(r) for r in windows.traffic_window(pl, "1 hour").collect())
    assert got == want and len(got) > 0


def test_login_window_stream_equals_batch(spark, page_files, scratch):
    path, schema, pl = page_files
    out = run_stream(spark, jobs.login_window_stream(stream_of(spark, path, schema), "1 day"), "login", scratch)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in windows.login_window(pl, "1 day").collect())


def test_retract_stream_equals_batch(spark, scratch):
    rows = [("a", 1, Decimal("10.00")), ("a", 2, Decimal("-5.00")), ("b", 1, Decimal("1.00")),
            ("a", 3, None), ("b", 2, Decimal("2.50"))]
    df = spark.createDataFrame(rows, "id string, seq int, amt decimal(10,2)")
    base = f"{scratch}/retract"
    for i, part in enumerate([rows[:2], rows[2:4], rows[4:]]):
        p = f"{base}/f{i}"
        spark.createDataFrame(part, df.schema).coalesce(1).write.parquet(p)
    flat_files(base, f"{base}_flat")
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}_flat")
    out = run_stream(spark, jobs.retract_stream(s, "id", ["seq"], ["amt"]), "retract", scratch)
    got = sorted((r.id, r.seq, r.amt, r.sign) for r in out.collect())
    want = sorted((r.id, r.seq, r.amt, r.sign) for r in
                  state.retract_duplicates(df, "id", ["seq"], ["amt"], sign_col="sign").collect())
    assert got == want


def test_upsert_batches(spark, scratch):
    path = f"{scratch}/upsert"
    b1 = spark.createDataFrame([("1", 1, "a", "c"), ("2", 1, "b", "c"), ("1", 2, "a2", "u")],
                               "id string, ts long, v string, op string")
    sinks.upsert_batch(b1, 0, path, "id", ["ts"])
    b2 = spark.createDataFrame([("2", 3, "b", "d"), ("3", 3, "c", "c")], b1.schema)
    sinks.upsert_batch(b2, 1, path, "id", ["ts"])
    sinks.upsert_batch(b2, 1, path, "id", ["ts"])  # a retried batch is idempotent
    # an older change that arrives late, of a live and of a deleted row
    sinks.upsert_batch(spark.createDataFrame([("1", 1, "late", "u"), ("2", 2, "late", "u")], b1.schema), 2, path, "id", ["ts"])

    def rows():
        return sorted((r.id, r.v) for r in sinks.read_upsert_table(spark, path, "id", ["ts"], "op").collect())
    assert rows() == [("1", "a2"), ("3", "c")]
    for upto in ({"none": 1}, {"none": 2}, None):
        sinks.compact_upsert_table(spark, path, "id", ["ts"], upto)
        assert rows() == [("1", "a2"), ("3", "c")]
    # a base that was written but not published counts for nothing
    b2.write.parquet(f"{path}/kind=base/run=cut_short/batch=0")
    assert rows() == [("1", "a2"), ("3", "c")]
    # batches behind the base still count
    sinks.upsert_batch(spark.createDataFrame([("1", 9, "newer", "u")], b1.schema), 3, path, "id", ["ts"])
    assert rows() == [("1", "newer"), ("3", "c")]


def test_a_new_checkpoint_overwrites_nothing(spark, scratch):
    schema = "id string, ts long, v string"

    def run(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/{name}")
        s = spark.readStream.schema(schema).parquet(f"{scratch}/{name}")
        q = s.writeStream.foreachBatch(lambda b, i: sinks.upsert_batch(b, i, f"{scratch}/t", "id", ["ts"])) \
            .option("checkpointLocation", f"{scratch}/ck_{name}").start()
        q.processAllAvailable()
        q.stop()
        return sorted((r.id, r.v) for r in sinks.read_upsert_table(spark, f"{scratch}/t", "id", ["ts"]).collect())
    assert run("one", [("a", 1, "x"), ("b", 1, "x")]) == [("a", "x"), ("b", "x")]
    assert run("one", [("a", 2, "y")]) == [("a", "y"), ("b", "x")]  # the same checkpoint: the next batch
    # another checkpoint counts from 0 again, beside the first run
    assert run("two", [("c", 1, "z")]) == [("a", "y"), ("b", "x"), ("c", "z")]
    sinks.compact_upsert_table(spark, f"{scratch}/t", "id", ["ts"])
    assert run("two", [("c", 2, "w")]) == [("a", "y"), ("b", "x"), ("c", "w")]
    assert run("three", [("a", 0, "old")]) == [("a", "y"), ("b", "x"), ("c", "w")]
    assert len(os.listdir(f"{scratch}/t/kind=change")) == 3


def test_split_log_batch_writes_all_outputs(spark, scratch):
    from martflow.sources import applog
    raw = applog.app_log_text(Tables(spark, SF)).checkpoint()
    sinks.split_log_batch(raw, 7, f"{scratch}/split")
    n = {k: spark.read.text(f"{scratch}/split/{k}/run=none/batch=7").count()
         for k in ["err", "start", "display", "action", "page", "dirty"]}
    assert all(v > 0 for v in n.values())


def test_home_detail_stream_equals_batch(spark, page_files, scratch):
    path, schema, pl = page_files
    # the sentinel must reach the stateful step: make it a home view
    s = stream_of(spark, path, schema).withColumn(
        "page_id", F.when(F.col("event_id") < 0, F.lit("home")).otherwise(F.col("page_id")))
    out = run_stream(spark, jobs.home_detail_window_stream(s, "1 hour"), "home_detail", scratch)
    want = sorted(tuple(r) for r in windows.home_detail_window(pl, "1 hour").collect())
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 0


def test_cart_uu_stream_equals_batch(spark, page_files, scratch):
    path, schema, pl = page_files
    as_cart = lambda df: df.select(F.col("event_id").cast("string").alias("id"),
                                   F.col("mid").alias("user_id"), F.col("ts").alias("et"))
    out = run_stream(spark, jobs.cart_uu_window_stream(as_cart(stream_of(spark, path, schema)), "1 hour"),
                     "cart_uu", scratch)
    want = sorted(tuple(r) for r in windows.cart_uu_window(as_cart(pl), "1 hour").collect())
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 0


def test_keep_latest_timer_emits_latest(spark, scratch):
    """Records are held per key and the newest is emitted once the
    processing-time delay has passed."""
    import time
    rows = [("a", 1, "x1"), ("a", 3, "x3"), ("a", 2, "x2"), ("b", 1, "y1")]
    df = spark.createDataFrame(rows, "id string, seq int, v string")
    df.coalesce(1).write.parquet(f"{scratch}/kl")
    s = spark.readStream.schema(df.schema).parquet(f"{scratch}/kl")
    out = jobs.keep_latest_stream(s, "id", ["seq"], delay_ms=500)
    q = (out.writeStream.format("memory").queryName("kl").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt_kl").trigger(processingTime="500 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("kl").count() < 2:
            time.sleep(1)
    finally:
        q.stop()
    assert sorted((r.id, r.seq, r.v) for r in spark.table("kl").collect()) == [("a", 3, "x3"), ("b", 1, "y1")]
