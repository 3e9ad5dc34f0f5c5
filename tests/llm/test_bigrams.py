"""Kneser-Ney bigrams whose counts are asked for by blocks of texts."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import bigrams, quality
from martflow.llm.common import dropped, prepare, written
from test_quality_pipeline import Brute, tokens


def test_packed_numbers_round_trip():
    for x in ([], [0], [0, 0], [1, 255, 256, 1 << 40], [(1 << 64) - 1, 0]):
        a = np.array(x, dtype=np.uint64)
        assert bigrams.unpacked(bigrams.packed(a)).tolist() == x


@pytest.mark.parametrize("block,shard", [(1 << 20, 1 << 20), (40, 100)])
def test_perplexities_match_brute_force_over_blocks(spark, monkeypatch, block, shard):
    """Few and many blocks and shards: the model of all texts of the training
    ids, a text's copies once, and every row's perplexity under it."""
    prepare(spark)
    monkeypatch.setattr(bigrams, "BLOCK_TOKENS", block)
    monkeypatch.setattr(bigrams, "SHARD_TOKENS", shard)
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["É", "A", "日本"]
    rows = [(i, " ".join(rng.choice(vocab[:rng.randrange(2, 43)]) for _ in range(rng.randrange(0, 50))), "en") for i in range(80)]
    rows += rows[:20] + [(3, "other text of an id", None), (None, "w1 w2 w1", "en"), (90, None, "en"), (91, "", "fr"), (91, None, "fr"), (92, "w1 \t\n w2 " * 300, "en")]
    rng.shuffle(rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(i, 1, 0) for i in (90, 91, 92)] + [(i, 0, 0) for i in range(60, 70)], "doc_id long, quality int, toxic int")
    ids = {r.doc_id for r in quality.trusted_ids(labels).where(quality.trained_on()).collect()}
    brute = Brute([tokens(t) for _, t in {(i, t) for i, t, _ in rows if i in ids}])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = quality.classify(docs, labels)
    got = sorted(((r.doc_id, r.n_tokens, r.perplexity) for r in out.collect()), key=str)
    want = sorted(((i, len(tokens(t)) - 1, brute.perplexity(tokens(t))) for i, t, _ in rows), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert sorted(g[2] for g in got) == pytest.approx(sorted(w[2] for w in want))


def test_without_training_texts_nothing_is_known(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, 5, "en", "a b"), (2, 6, None, "")], "doc_id long, text_key long, lang string, text string")
    none = bigrams.log_probabilities(docs, lambda rows: rows.limit(0), quality.discounts)
    assert {(r.doc_id, r.n_tokens, r.v) for r in none.collect()} == {(1, 3, 0.0), (2, 1, 0.0)}
    assert bigrams.log_probabilities(docs.limit(0), lambda rows: rows, quality.discounts).count() == 0


def test_a_block_asks_for_a_pair_once(spark, monkeypatch):
    """What is sent grows with the distinct pairs of a block, not with its words."""
    prepare(spark)
    monkeypatch.setattr(bigrams, "PAIR_TURNS", 1)
    docs = spark.range(50, numPartitions=1).select(F.col("id").alias("doc_id"), F.col("id").alias("text_key"), F.lit("en").alias("lang"), F.repeat(F.lit("a b "), 1000).alias("text"))
    whole = bigrams.blocks(docs).where("row is null").withColumn("rows", F.array(F.lit(0), F.lit(7)))
    asked, = whole.select("block", "words", "stream", "sizes", "rows").mapInArrow(bigrams._ask_pairs(1, 0), bigrams.ASKED_KINDS).collect()
    assert sorted(bigrams.unpacked(asked.counts[0]).tolist()) == [2, 2, 2 * 999, 2 * 1000]  # begin a, b end, b a, a b
    assert len(bigrams.unpacked(asked.hashes)) == 4


def test_written_leaves_no_shuffle_files(spark):
    prepare(spark)
    files = lambda: sum("shuffle_" in str(f) for f in _list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()))
    _list = lambda seq: [seq.apply(k) for k in range(seq.size())]
    before = files()
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    t = written(spark.range(1000).repartition(7, "id"))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and t.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept
    dropped(t)
    assert not [f for f in t.inputFiles() if _exists(spark, f)]


def _exists(spark, f):
    path = spark._jvm.org.apache.hadoop.fs.Path(f)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
