"""Streams with a config stream, idle state, transactions, a snapshot start and
catalog actions."""

import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from martflow.sources import cdc as cdc_src
from martflow.sources import snapshot
from martflow.streaming import jobs, tables, txn
from tests.test_streaming import run_stream

ENV = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms long, pos long"


def drop_json(rows, path, name, k):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    os.utime(f"{path}/{name}", (1_000_000 + k, 1_000_000 + k))


def file_stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


# --------------------------------------------------------------------------
# the config as a second stream
# --------------------------------------------------------------------------

def test_config_stream_with_preload(spark, scratch):
    """Records and config changes in one topic, a file per micro-batch; the
    expected rows come from walking them in order with a plain dictionary."""
    rnd = random.Random(1)
    keys = [("cart_info", "c"), ("order_info", "u"), ("comment_info", "r")]
    preload = {("cart_info", "c"): ("dwd_cart", "id,n"), ("comment_info", "r"): ("dwd_comment", "id")}
    state = {k: (0, *v) for k, v in preload.items()}
    want, ts = [], 1000
    for batch in range(4):
        rows = []
        for _ in range(60):
            ts += 10
            table, op = rnd.choice([keys[0], *keys, ("unknown", "c")])
            if rnd.random() < 0.15:
                o = rnd.choice("cud")
                sink = f"sink{rnd.randrange(3)}"
                rows.append({"kind": "config", "op": o, "ts_ms": ts, "source_table": table, "source_type": op, "sink_table": sink, "sink_columns": "id"})
                state[table, op] = (ts, None, None) if o == "d" else (ts, sink, "id")
            else:
                rows.append({"kind": "record", "op": op, "ts_ms": ts, "pos": 0, "source": {"table": table}, "after": {"id": str(ts), "n": "7", "x": "y"}})
                if state.get((table, op), (0, None))[1]:
                    _, sink, cols = state[table, op]
                    want.append((sink, tuple(sorted([("ts_ms", str(ts)), *((c, {"id": str(ts), "n": "7"}[c]) for c in cols.split(","))]))))
        drop_json(rows, f"{scratch}/topic", f"{batch}.json", batch)
    schema = ENV + ", kind string, source_table string, source_type string, sink_table string, sink_columns string"
    topic = file_stream(spark, f"{scratch}/topic", schema)
    ods = topic.where("kind = 'record'").select("before", "after", "source", "op", "ts_ms", "pos")
    configs = topic.where("kind = 'config'").select("op", "ts_ms", "source_table", "source_type", "sink_table", "sink_columns")
    start = spark.createDataFrame([(*k, 0, *v) for k, v in preload.items()], "source_table string, source_type string, ts_ms long, sink_table string, sink_columns string")
    out = run_stream(spark, jobs.route_by_config_stream(ods, configs, start, salts=3), "config_routed", scratch)
    got = [(r.sink_table, tuple(sorted(r.data.items()))) for r in out.collect()]
    assert sorted(got) == sorted(want) and len(want) > 50


# --------------------------------------------------------------------------
# idle retention
# --------------------------------------------------------------------------

@pytest.mark.parametrize("renew", [True, False])
def test_idle_join_keeps_rows_in_use(spark, scratch, renew):
    left = [("a", "l1", 0), ("b", "l2", 0), ("c", "l3", 0), (None, "l4", 0)]
    right = [[("a", "r1", 900), ("b", "r2", 1100), (None, "r3", 5)], [("a", "r4", 1500)], [("a", "r5", 2400), ("c", "r6", 2400)]]
    base = 10_000  # a watermark starts at 0 and takes what isn't newer for late
    for i, rows in enumerate([[{"k": k, "v": v, "t": base + t} for k, v, t in left], [], [], []]):
        drop_json(rows, f"{scratch}/left", f"{i}.json", i)
    for i, rows in enumerate([[], *[[{"k": k, "v": v, "t": base + t} for k, v, t in batch] for batch in right]]):
        drop_json(rows, f"{scratch}/right", f"{i}.json", i)
    l = file_stream(spark, f"{scratch}/left", "k string, v string, t long")  # noqa: E741
    r = file_stream(spark, f"{scratch}/right", "k string, v string, t long").toDF("k2", "v2", "t2")
    out = run_stream(spark, jobs.idle_join_stream(l, r, ("k", "k2"), 1000, ("t", "t2"), renew=renew), f"idle_{renew}", scratch)
    got = sorted((x.k, x.v, x.v2, x.t - base, x.t2 - base) for x in out.collect())
    # a partner inside the limit; one outside it (b, c); those that only renewal lets in
    late = [("a", "l1", "r4", 0, 1500), ("a", "l1", "r5", 0, 2400)]
    assert got == sorted([("a", "l1", "r1", 0, 900), *(late if renew else [])])


def test_cancelled_orders_by_idle_state(spark, scratch):
    detail = {"id": "d1", "order_id": "o", "user_id": "u", "sku_id": "s", "ts_ms": 1000}
    cancel = lambda o, ts: {"op": "u", "ts_ms": ts, "source": {"table": "order_info"}, "before": {"order_status": "1001"},
                            "after": {"id": o, "order_status": "1003", "operate_time": str(ts)}}
    drop_json([detail, dict(detail, id="d2", order_id="late")], f"{scratch}/detail", "0.json", 0)
    drop_json([cancel("o", 1_805_999), cancel("late", 1_806_000)], f"{scratch}/ods", "0.json", 0)
    from martflow.operators.facts import ORDER_DETAIL_COLS
    cols = ", ".join(f"{c} {'long' if c == 'ts_ms' else 'string'}" for c in ORDER_DETAIL_COLS)
    d = file_stream(spark, f"{scratch}/detail", cols).withColumn("et", F.timestamp_millis("ts_ms"))
    ods = file_stream(spark, f"{scratch}/ods", ENV)
    out = run_stream(spark, jobs.order_cancel_fact_idle_stream(d, ods, event_time=True), "cancel_idle", scratch)
    assert [(r.id, r.order_id, r.ts_ms, r.date_id) for r in out.collect()] == [("d1", "o", 1_805_999, "1970-01-01")]


# --------------------------------------------------------------------------
# transactional sink
# --------------------------------------------------------------------------

def _txn(spark, stream, scratch, run="run1"):
    return txn.txn_stream(stream, f"{scratch}/out", run, f"{scratch}/ckpt_{run}", trigger={"availableNow": True})


def _fails_on(flag):
    @F.pandas_udf("string")
    def check(v: pd.Series) -> pd.Series:
        if os.path.exists(flag) and (v == "poison").any():
            raise RuntimeError("killed midway")
        return v
    return check


def test_a_killed_batch_leaves_no_rows(spark, scratch):
    schema = "topic string, v string"
    for i in range(3):
        rows = [{"topic": "a" if k % 3 else "b", "v": f"{i}-{k}"} for k in range(50)]
        drop_json([*rows, {"topic": "a", "v": "poison" if i == 1 else "last"}], f"{scratch}/in", f"{i}.json", i)
    flag = f"{scratch}/flag"
    open(flag, "w").close()
    check = _fails_on(flag)
    # each batch in several tasks: some have written their rows when one dies
    s = file_stream(spark, f"{scratch}/in", schema).repartition(4).withColumn("v", check("v"))
    q = _txn(spark, s, scratch)
    with pytest.raises(Exception, match="killed midway"):
        q.awaitTermination(120)
    both = lambda: sorted(r.v for t in ("a", "b") for r in txn.read_committed(spark, f"{scratch}/out", t, "v string").collect())
    assert both() == sorted([f"0-{k}" for k in range(50)] + ["last"])  # batch 0 whole, nothing of batch 1
    os.unlink(flag)
    _txn(spark, s, scratch).awaitTermination(120)
    assert both() == sorted([f"{i}-{k}" for i in range(3) for k in range(50)] + ["last", "last", "poison"])
    # a run with another checkpoint starts at batch 0 again and overwrites nothing
    _txn(spark, s, scratch, "run2").awaitTermination(120)
    assert len(both()) == 2 * 153
    # a batch that is committed twice keeps its first manifest
    w = txn.TxnWriter({"path": f"{scratch}/out", "run": "run2", "topic": "a"}, spark.createDataFrame([], "v string").schema)
    import pyarrow as pa
    again = w.write(iter([pa.RecordBatch.from_arrays([pa.array(["twice"])], names=["v"])]))
    assert os.path.exists(f"{scratch}/out/a/{again.files[0][1]}")
    w.commit([again, None], 0)
    assert len(both()) == 2 * 153 and not os.path.exists(f"{scratch}/out/a/{again.files[0][1]}")
    stray = w.write(iter([pa.RecordBatch.from_arrays([pa.array(["aborted"])], names=["v"])]))
    w.abort([stray, None], 99)
    assert not os.path.exists(f"{scratch}/out/a/{stray.files[0][1]}") and len(both()) == 2 * 153


# --------------------------------------------------------------------------
# snapshot, then changes
# --------------------------------------------------------------------------

def test_snapshot_then_changes_across_restarts(spark, scratch):
    snap, ch, out = f"{scratch}/snap", f"{scratch}/changes", f"{scratch}/out"
    spark.range(10).select(F.col("id"), F.lit("x").alias("name")).repartition(3).write.parquet(snap)
    os.makedirs(ch)

    def change(k):
        with open(f"{ch}/{k:03d}.json", "w") as f:
            f.write(json.dumps({"op": "u", "ts_ms": k, "source": {"table": "config"}, "before": {"id": 1}, "after": {"id": f"c{k}"}}) + "\n")

    def run(stop=None):
        s = snapshot.read_snapshot_then_changes(spark, snap, ch, "config")
        q = s.select(F.col("after")["id"].alias("id"), "op", "ts_ms", F.col("source")["table"].alias("t")).writeStream.format("parquet") \
            .option("path", out).option("checkpointLocation", f"{scratch}/ckpt").start()
        q.processAllAvailable()
        q.stop()
        return sorted((r.op, r.id) for r in spark.read.parquet(out).collect())

    rows = [("r", str(i)) for i in range(10)]
    assert run() == sorted(rows)
    change(1)
    change(2)
    assert run() == sorted([*rows, ("u", "c1"), ("u", "c2")])
    # a snapshot file that comes later is no change; nothing is read twice
    spark.range(90, 91).select("id", F.lit("late").alias("name")).coalesce(1).write.mode("append").parquet(snap)
    change(3)
    assert run() == sorted([*rows, ("u", "c1"), ("u", "c2"), ("u", "c3")])
    assert run() == sorted([*rows, ("u", "c1"), ("u", "c2"), ("u", "c3")])


def test_a_batch_is_planned_from_its_offsets(scratch):
    snap, ch = f"{scratch}/s", f"{scratch}/c"
    for d, names in ((snap, ["a.parquet", "b.parquet"]), (ch, ["1.json", "2.json", "3.json"])):
        os.makedirs(d)
        for n in names:
            open(f"{d}/{n}", "w").close()
    options = {"snapshot": snap, "changes": ch, "table": "t"}
    first = snapshot.SnapshotReader(options)
    start, end = first.initialOffset(), first.latestOffset()
    open(f"{ch}/4.json", "w").close()
    other = snapshot.SnapshotReader(options)  # another driver
    names = lambda parts: [p.name for p in parts]
    assert names(other.partitions(start, end)) == ["a.parquet", "b.parquet", "1.json", "2.json", "3.json"]
    assert names(other.partitions(end, other.latestOffset())) == ["4.json"]


# --------------------------------------------------------------------------
# catalog actions
# --------------------------------------------------------------------------

def test_config_creates_drops_and_recreates_tables(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dims LOCATION 'file:{scratch}/dims'")
    conf = lambda rows: spark.createDataFrame(rows, "op string, ts_ms long, sink_table string, sink_columns string")
    apply = lambda rows: tables.apply_config(spark, conf(rows), "dims")
    count = lambda t: spark.table(f"dims.{t}").count()
    first = [("r", 1, "users", "id,name"), ("c", 2, "skus", "id"), ("c", 3, "gone", "id"), ("d", 4, "gone", "id"), ("x", 5, "skus", "no")]
    assert apply(first) == {"users": "created", "skus": "created", "gone": "kept"}
    assert spark.table("dims.users").columns == ["id", "name"]
    spark.sql("INSERT INTO dims.users VALUES ('1', 'a')")
    spark.sql("INSERT INTO dims.skus VALUES ('1')")
    assert apply(first)["users"] == "kept" and count("users") == 1  # the batch again
    second = [("u", 10, "users", "id,name,age"), ("d", 11, "skus", "id")]
    assert apply(second) == {"users": "recreated", "skus": "dropped"}
    assert spark.table("dims.users").columns == ["id", "name", "age"] and count("users") == 0
    spark.sql("INSERT INTO dims.users VALUES ('2', 'b', '3')")
    assert apply(second) == {"users": "kept", "skus": "kept"} and count("users") == 1  # a retried batch spares later rows
    third = [("d", 20, "users", "id"), ("c", 21, "users", "id"), ("c", 22, "skus", "id")]
    assert apply(third) == {"users": "recreated", "skus": "created"} and count("users") == 0
    with pytest.raises(ValueError):
        apply([("c", 30, "a; DROP TABLE users", "id")])


def test_config_table_stream(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dims2 LOCATION 'file:{scratch}/dims2'")
    cols = "op string, ts_ms long, sink_table string, sink_columns string"
    drop_json([{"op": "r", "ts_ms": 1, "sink_table": "t1", "sink_columns": "id"}, {"op": "r", "ts_ms": 1, "sink_table": "t2", "sink_columns": "id"}], f"{scratch}/conf", "0.json", 0)
    drop_json([{"op": "d", "ts_ms": 2, "sink_table": "t1", "sink_columns": "id"}, {"op": "u", "ts_ms": 3, "sink_table": "t2", "sink_columns": "id,v"}], f"{scratch}/conf", "1.json", 1)
    q = tables.config_tables_stream(file_stream(spark, f"{scratch}/conf", cols), f"{scratch}/ckpt", "dims2", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert [t.name for t in spark.catalog.listTables("dims2") if not t.isTemporary] == ["t2"] and spark.table("dims2.t2").columns == ["id", "v"]
