"""Watermarks over recorded arrivals against a plain loop and against a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import lateness

SCHEMA = "id long, arrival long, et long"


def plain(rows, size, step, lag):
    """id -> (watermark, late) row by row."""
    known = sorted((a // step, e) for _, a, e in rows if a is not None and e is not None)
    out = {}
    for i, a, e in rows:
        mark = max((t for s, t in known if a is not None and s < a // step), default=None)
        has_step = a is not None and any(s == a // step for s, _ in known)
        mark = mark - lag if mark is not None and has_step else None
        late = None if a is None or e is None else mark is not None and (e // size + 1) * size <= mark
        out[i] = (mark, late)
    return out


def met(spark, rows, size, step, lag):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.id: (r.watermark, r.late) for r in lateness.with_watermark_met(df, "arrival", "et", size, step, lag).collect()}


@pytest.mark.parametrize("seed, spread, step, lag", [(1, 4_000, 10, 0), (2, 300, 7, 25), (3, 5_000_000, 100, 400)])
def test_equals_a_plain_loop(spark, seed, spread, step, lag):
    rnd = random.Random(seed)  # 5,000,000 / 100 steps lie in many spans; negative times floor downwards
    rows = []
    for i in range(300):
        e = rnd.randrange(-spread // 10, spread)
        rows.append((i, e + rnd.choice([0, 3, 50, spread // 2]), e))
    rows += [(900, None, 5), (901, 5, None), (902, None, None), (903, spread * 2, None)]
    got = met(spark, rows, 60, step, lag)
    assert got == plain(rows, 60, step, lag)
    assert any(late for _, late in got.values())


def test_ties_repeats_and_no_rows(spark):
    rows = [(1, 100, 100), (1, 100, 100), (2, 200, 10), (3, 200, 200)]  # 2 meets 100 - 30: its window [0, 60) is over
    df = spark.createDataFrame(rows, SCHEMA)
    on_time, late = lateness.split_late(df, "arrival", "et", 60, 10, 30)
    assert sorted(r.id for r in on_time.collect()) == [1, 1, 3]
    assert [(r.id, r.watermark) for r in late.collect()] == [(2, 70)]
    assert met(spark, [], 60, 10, 0) == {}
    one, none = lateness.split_late(df, "arrival", "et", 60, 1_000, 0)  # all in one step: nobody is late
    assert (one.count(), none.count()) == (4, 0)


def test_a_hot_step_is_no_sorted_group(spark):
    df = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("arrival"), F.col("id").alias("et"))
    met_ = lateness.with_watermark_met(df, "arrival", "et", 60, 10)
    plan = met_._jdf.queryExecution().optimizedPlan().toString()
    seen = [line for line in plan.splitlines() if "Window [" in line]
    assert len(seen) == 2  # over one row a step and one a span, never over rows
    assert all("max(top" in line or "max(t#" in line for line in seen), seen
    assert met_.count() == 200_000


def test_a_stream_drops_the_same_rows(spark, scratch):
    rnd = random.Random(7)
    rows = []
    for i in range(120):
        e = 1_704_067_200_000 + rnd.randrange(40_000)
        rows.append((i, e + rnd.choice([0, 500, 9_000, 25_000]), e))
    size, step, lag = 5_000, 10_000, 2_000
    batch, late = lateness.split_late(spark.createDataFrame(rows, SCHEMA), "arrival", "et", size, step, lag)
    want = {r.w: r.n for r in batch.groupBy((F.floor(F.col("et") / size) * size).alias("w")).agg(F.count("id").alias("n")).collect()}
    assert late.count() > 5
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        end = (10_000, 1_704_067_200_000 + 10_000_000, 1_704_067_200_000 + 10_000_000)  # closes all windows
        for s in sorted({a // step for _, a, _ in rows}) + [None]:
            part = [r for r in rows if s is not None and r[1] // step == s] or [end]
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
            d = spark.readStream.schema(SCHEMA).parquet(src).withColumn("ts", F.timestamp_millis("et"))
            w = d.withWatermark("ts", f"{lag} milliseconds").groupBy(F.window("ts", f"{size} milliseconds")).agg(F.count("id").alias("n"))
            q = w.select(F.unix_millis("window.start").alias("w"), "n").writeStream.format("parquet").outputMode("append") \
                .option("checkpointLocation", ck).trigger(availableNow=True).start(out)
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {r.w: r.n for r in spark.read.parquet(out).collect()}
    assert got == want
