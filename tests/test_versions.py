"""Versioned joins, holds and dictionary cuts against plain versions."""

import itertools
import random

from pyspark.sql import functions as F

from martflow.operators import facts, segment, state, versions
from martflow.plans.catalog import DETAIL_FEEDS
from martflow.sources import retail
from martflow.sources.tables import Tables

SF = "/root/testdata/sf0.001"
ENV = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"


def src(t):
    return {"db": "stream_retail", "table": t}


# --------------------------------------------------------------------------
# validity
# --------------------------------------------------------------------------

def plain_versions(changes):
    """key -> [(from, to, value, gone)] of (key, t, no, value, gone)."""
    last = {}
    for k, t, no, v, gone in changes:
        if k is not None and t is not None and ((k, t) not in last or last[k, t][0] < (no, v, gone)):
            last[k, t] = ((no, v, gone), v, gone)
    out = {}
    for (k, t), (_, v, gone) in sorted(last.items()):
        out.setdefault(k, []).append([t, None, v, gone])
    for rows in out.values():
        for a, b in zip(rows, rows[1:]):
            a[1] = b[0]
    return out


def changes(rnd, n, keys, most):
    return [(rnd.choice(keys), rnd.choice([None, *range(0, most, 7)]) if rnd.random() < .1 else rnd.randrange(most), i,
             f"v{rnd.randrange(5)}", rnd.random() < .2) for i in range(n)]


def test_validity_across_spans(spark):
    rnd = random.Random(1)
    rows = changes(rnd, 600, ["a", "hot", "hot", "hot", "c", None], 5000)
    df = spark.createDataFrame(rows, "k string, ts_ms long, no long, v string, gone boolean")
    want = sorted((k, f, t, v) for k, vs in plain_versions(rows).items() for f, t, v, gone in vs if not gone)
    for span in (1, 100, 10 ** 9):
        got = versions.versions(df, "k", [F.col("no")], deleted=F.col("gone"), span_ms=span)
        assert sorted((r.k, r.valid_from, r.valid_to, r.v) for r in got.collect()) == sorted(want, key=lambda r: (r[0], r[1]))


def test_lookup_as_of_a_time(spark):
    rnd = random.Random(2)
    rows = changes(rnd, 300, ["a", "hot", "c"], 9000)
    table = plain_versions(rows)
    fact = [(i, rnd.choice(["hot", "hot", "hot", "a", "zz", None]), rnd.choice([None, rnd.randrange(-500, 12_000)])) for i in range(2000)]

    def at(k, t):
        if k is None or t is None:
            return None
        return next((v for f, to, v, gone in table.get(k, []) if f <= t and (to is None or t < to) and not gone), None)

    df = spark.createDataFrame(rows, "k string, ts_ms long, no long, name string, gone boolean")
    valid = versions.versions(df, "k", [F.col("no")], deleted=F.col("gone"), span_ms=1000).select("k", "name", "valid_from", "valid_to")
    f = spark.createDataFrame(fact, "i long, code string, t long")
    for span in (50, 1000, 10 ** 7):
        named = versions.as_of_join(f, valid.withColumnRenamed("k", "code"), "code", "t", "left", span)
        assert sorted((r.i, r["name"]) for r in named.collect()) == sorted((i, at(k, t)) for i, k, t in fact)
        inner = versions.as_of_join(f, valid.withColumnRenamed("k", "code"), "code", "t", span_ms=span)
        assert inner.count() == sum(at(k, t) is not None for _, k, t in fact)
    assert versions.as_of_join(f.limit(0), valid.withColumnRenamed("k", "code"), "code", "t").count() == 0


# --------------------------------------------------------------------------
# change rows of the order detail join
# --------------------------------------------------------------------------

def test_sums_of_changes_are_the_fact(spark):
    ods = retail.ods(Tables(spark, SF), DETAIL_FEEDS).persist()
    cols = [c for c in facts.CHANGE_COLS if c not in ("change_ms", "sign")]
    left = facts.order_detail_changes(ods).groupBy(*cols).agg(F.sum("sign").alias("n")).where("n <> 0")
    fact = facts.order_detail_fact(ods).select(*cols)
    assert left.where("n <> 1").count() == 0
    assert left.drop("n").exceptAll(fact).count() == 0 and fact.exceptAll(left.drop("n")).count() == 0
    ods.unpersist()


def detail(i, order, ts, total="9"):
    return (None, {"id": i, "order_id": order, "sku_id": "s", "sku_num": "1", "order_price": "2", "create_time": "0", "split_total_amount": total}, src("order_detail"), "c", ts)


def test_a_late_activity_retracts_the_null_link(spark):
    rows = [detail("d", "o", 100),
            (None, {"id": "o", "user_id": "u", "province_id": "p"}, src("order_info"), "c", 50),
            (None, {"order_detail_id": "d", "activity_id": "a1", "activity_rule_id": "r"}, src("order_detail_activity"), "c", 120),
            (None, {"order_detail_id": "d", "activity_id": "a1", "activity_rule_id": "r"}, src("order_detail_activity"), "c", 130),  # a repeat
            (None, {"order_detail_id": "d", "coupon_id": "c1"}, src("order_detail_coupon"), "c", 90),  # before its detail
            (None, {"order_detail_id": None, "activity_id": "a0"}, src("order_detail_activity"), "c", 10),
            detail(None, "o", 200), detail(None, "o", 210, "8"), detail("x", None, 5), detail("y", "no such order", 5)]
    df = spark.createDataFrame(rows, ENV)
    got = sorted((r.change_ms, r.sign, r.id or "", r.activity_id or "", r.coupon_id or "") for r in facts.order_detail_changes(df).collect())
    assert got == [(100, 1, "d", "", "c1"), (120, -1, "d", "", "c1"), (120, 1, "d", "a1", "c1"), (200, 1, "", "", ""), (210, 1, "", "", "")]
    # the fact: null ids keep apart and take no link
    fact = sorted((r.id or "", r.activity_id or "", r.split_total_amount) for r in facts.order_detail_fact(df).collect())
    assert fact == [("", "", "8"), ("", "", "9"), ("d", "a1", "9")]


def test_a_detail_waits_for_its_order_and_follows_it(spark):
    rows = [detail("d", "o", 100), (None, {"id": "o", "user_id": "u", "province_id": "p"}, src("order_info"), "c", 150),
            (None, {"id": "o", "user_id": "u", "province_id": "q"}, src("order_info"), "c", 300), detail("d", "o", 200, "7")]
    got = sorted((r.change_ms, r.sign, r.province_id, r.split_total_amount) for r in facts.order_detail_changes(spark.createDataFrame(rows, ENV)).collect())
    assert got == [(150, 1, "p", "9"), (200, -1, "p", "9"), (200, 1, "p", "7"), (300, -1, "p", "7"), (300, 1, "q", "7")]


# --------------------------------------------------------------------------
# hold and flush
# --------------------------------------------------------------------------

def test_holds_are_walked_in_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "hot", "hot", "hot", None]), rnd.choice([None, rnd.randrange(400_000)]) if rnd.random() < .02 else rnd.randrange(400_000), i) for i in range(3000)]
    rows += [("edge", 0, 1), ("edge", 5000, 2), ("edge", 9999, 3), ("edge", 10_000, 4), ("edge", 10_000, 5)]
    want = []
    for k in {r[0] for r in rows}:
        start = held = None
        for t, no in sorted((t, no) for key, t, no in rows if key == k and t is not None):
            if start is None or t >= start + 5000:
                if start is not None:
                    want.append((k, *held, start, start + 5000))
                start = t
            held = (t, no)
        want.append((k, *held, start, start + 5000))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame(rows, "k string, ts_ms long, no long")
    for size in (old, "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = [tuple(r) for r in state.hold_and_flush(df, "k", "ts_ms", ["no"], 5000).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert state.hold_and_flush(df.limit(0), "k", "ts_ms", ["no"]).count() == 0


# --------------------------------------------------------------------------
# dictionary cuts
# --------------------------------------------------------------------------

def plain_cut(run, words):
    """Every path through the lattice, the best one kept."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(run)]
        parts = [run[a:b] for a, b in zip(at, at[1:])]
        if any(len(p) > 1 and p not in words for p in parts):
            continue
        rank = (sum(p not in words for p in parts), len(parts), -sum(len(p) ** 2 for p in parts), [-len(p) for p in parts])
        if best is None or rank < best[0]:
            best = (rank, parts)
    return best[1]


def test_coarsest_cut_is_the_best_path(spark):
    rnd = random.Random(4)
    words = {"".join(rnd.choice("研究生命起源") for _ in range(rnd.randint(1, 4))) for _ in range(60)}
    runs = {"".join(rnd.choice("研究生命起源科") for _ in range(rnd.randint(1, 11))) for _ in range(300)}
    words |= {"研究生", "研究", "生命", "起源"}
    runs |= {"研究生命起源"}
    r = spark.createDataFrame([(x,) for x in [*runs, "", None, *list(runs)[:50]]], "run string")
    d = spark.createDataFrame([(x, 1) for x in [*words, "", None, "研究"]], "word string, n int")
    want = {x: plain_cut(x, words) for x in runs}
    for limit in (segment.TRIE_BYTES, 10):  # as a trie, as a join
        got = {x.run: x.pieces for x in segment.segment_runs(r, d, trie_bytes=limit).collect()}
        assert got == want
    # a greedy longest match would start with 研究生
    small = spark.createDataFrame([("研究生",), ("研究",), ("生命",), ("起源",)], "word string")
    assert segment.segment_runs(r.where("run = '研究生命起源'"), small).first().pieces == ["研究", "生命", "起源"]


def test_cut_edges(spark):
    r = spark.createDataFrame([("ab😀c",), ("ab😀c",)], "run string")
    none = spark.createDataFrame([(None,), ("",)], "word string")
    row = segment.segment_runs(r, none).collect()
    assert [(x.n, x.pieces) for x in row] == [(2, ["a", "b", "😀", "c"])]
    d = spark.createDataFrame([("ab",), ("b😀c",)], "word string")
    texts = spark.createDataFrame([("AB😀C x",), (None,), ("",)], "text string")
    counts = {x.keyword: x.keyword_count for x in segment.segment_counts(texts, "text", d, F.split(F.lower("text"), " ")).collect()}
    assert counts == {"a": 1, "b😀c": 1, "x": 1}  # equally loose: the larger squares win
    long = spark.createDataFrame([("ab" * 20_000,)], "run string")
    assert segment.segment_runs(long, d).first().pieces == ["ab"] * 20_000


def test_sides_are_merged_in_one_exchange(spark):
    """The fold per time, the walk and the look ahead share one exchange by key; several rows of a time are folded."""
    main = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 5, 1, "z"), ("b", 3, 1, "w")], "k string, ts_ms long, no long, v string")
    side = spark.createDataFrame([("a", 0, "p"), ("a", 3, "q"), ("a", 3, "r"), ("b", 9, "s"), ("c", 1, "t")], "k string, ts_ms long, u string")
    out = versions.merged(main, {"side": side}, "k").select("k", "valid_from", "valid_to", "main.v", "side.u")
    assert sorted(map(tuple, out.collect()), key=lambda r: r[:2]) == [
        ("a", 1, 3, "y", "p"), ("a", 3, 5, "y", "r"), ("a", 5, None, "z", "r"), ("b", 3, 9, "w", None), ("b", 9, None, "w", "s")]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
