"""Kneser-Ney classifier against a dictionary model; pipeline stages."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martflow.llm import neardup, quality, secrets, tiling
from martflow.llm.common import prepare
from test_dups import brute_docs

SF = "/root/testdata/sf0.01"


class Brute:
    """Interpolated modified Kneser-Ney bigrams, by the book."""

    def __init__(self, texts):
        two = Counter(p for t in texts for p in zip(t, t[1:]))
        one = Counter(b for _, b in two)

        def discounts(counts):
            n = [sum(v == k for v in counts.values()) for k in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            d = [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else y * k, 0.05), k - 0.05) for k in (1, 2, 3)]
            return lambda c: d[min(c, 3)]
        self.two, self.one, self.d1, self.d2 = two, one, discounts(one), discounts(two)
        self.total, self.types = sum(one.values()), len(one)
        self.rest1 = sum(map(self.d1, one.values())) / self.total
        self.n, self.rest = Counter(), defaultdict(float)
        for (a, _), c in two.items():
            self.n[a] += c
            self.rest[a] += self.d2(c)

    def p(self, a, b):
        low = self.rest1 / (self.types + 1)
        if b in self.one:
            low += (self.one[b] - self.d1(self.one[b])) / self.total
        if a not in self.n:
            return low
        c = self.two[a, b]
        return ((c - self.d2(c)) if c else 0) / self.n[a] + self.rest[a] / self.n[a] * low

    def perplexity(self, t):
        return 10 ** (-sum(math.log10(self.p(a, b)) for a, b in zip(t, t[1:])) / (len(t) - 1))


def tokens(t):
    return [quality.BEGIN, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), quality.FINISH]


@pytest.mark.parametrize("broadcast", [True, False])
def test_perplexity_matches_brute_force(spark, broadcast):
    prepare(spark)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(30)] + ["É", "A"]
    texts = [" ".join(rng.choice(vocab[:rng.randrange(2, 32)]) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    train, test = texts[:40], [*texts[40:], None, "", "new words only", texts[0], texts[0]]
    t = spark.createDataFrame([(i, tokens(x)) for i, x in enumerate(train)], "doc_id long, words array<string>")
    d = spark.createDataFrame([(i, x, None) for i, x in enumerate(test)] + [(0, test[0], None)], "doc_id long, text string, lang string")
    table, unknown = quality.model(t)
    finish = table.where(F.col("gram") == quality._gram(F.lit(quality.FINISH))).first()["value"]
    brute = Brute([tokens(x) for x in train])
    got = {r.doc_id: r for r in quality.perplexities(d, table, unknown, broadcast).collect()}
    for i, x in enumerate(test):
        r = got[i]
        assert r.n_tokens == len(tokens(x)) - 1 and r.copies == (2 if i == 0 else 1)
        assert 10 ** (-(r.v + r.copies * finish + r.n * unknown) / r.n) == pytest.approx(brute.perplexity(tokens(x)))
    # probabilities after any word sum to 1, the unknown word's included
    for a in ("w0", "w1", "never"):
        assert sum(brute.p(a, b) for b in brute.one) + brute.p(a, "never") == pytest.approx(1)


def test_classifier_rejects_junk_and_keeps_clean(spark):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels)
    x = out.join(labels, "doc_id").toPandas()
    assert out.count() == docs.count()
    assert x[x.quality == 1].kept.mean() > 0.95 and x[x.quality == 0].kept.mean() < 0.5
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == out.where("kept").count()


def test_training_sample_is_bounded_in_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, f"hot id text {i}", "en") for i in range(5000)] + [(k, "plain text", "en") for k in range(2, 30)] * 3, "doc_id long, text string, lang string")
    trusted = spark.range(1, 30).withColumnRenamed("id", "doc_id")
    texts = quality.training_texts(docs, trusted, quality.Sample(rows=25, words=10_000)).collect()
    ids = [r.doc_id for r in texts]
    assert 10 < len(ids) <= 25 and len(set(ids)) == len(ids)
    few = quality.training_texts(docs, trusted, quality.Sample(rows=25, words=20)).collect()
    assert 0 < sum(len(r.words) for r in few) <= 20


def test_every_trusted_text_trains(spark):
    """More trusted texts than a sample holds: all of the training ids count, repeated rows once."""
    prepare(spark)
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('word', id) as text", "'en' as lang")
    docs = docs.unionByName(docs.where("doc_id < 50")).unionByName(spark.createDataFrame([(0, "other text", "en"), (1, "other text", "en"), (2, "other text", "en")], docs.schema))
    trusted = spark.range(6000).withColumnRenamed("id", "doc_id")
    train = {r.doc_id for r in trusted.where(quality.trained_on()).collect()}
    got = Counter((r.doc_id, r.words[1]) for r in quality.training_texts(docs, trusted).collect())
    assert 4000 < len(train) < 6000
    assert got == Counter([(i, f"word{i}") for i in train] + [(i, "other") for i in (0, 1, 2) if i in train])
    table, unknown = quality.model(quality.training_texts(docs, trusted))
    seen = {r.gram for r in table.collect()}
    grams = {r.doc_id: r.g for r in docs.select("doc_id", quality._gram(F.lower("text")).alias("g")).where("text like 'word%'").collect()}
    assert {i for i, g in grams.items() if g in seen} == train


def test_classifier_edges(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (2, None, None, "x"), (None, "d", "en", "x"), (3, "", "fr", "x"),
                                  (4, "z " * 30_000, "en", "x")], "doc_id long, text string, lang string, perplexity string")
    kind = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, 1, 0)], [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, None)], [(1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 1, 0)]):
        out = quality.classify(docs, spark.createDataFrame(labels, kind)).collect()
        assert sorted(str(r.doc_id) for r in out) == ["1", "1", "2", "3", "4", "None"]
        if not labels:
            assert all(r.kept and r.threshold is None for r in out)
    assert quality.classify(docs.limit(0), spark.createDataFrame([], kind)).count() == 0


def test_pipeline_stages(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "benchmark", "secrets", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in kept.collect()}
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        after = {(r.doc_id, r.text) for r in kept.collect()}
        if name == "near_duplicates":
            brute = {int(d) for d, _, c, _ in brute_docs(sorted(before, key=str), 5) if d == c}
            assert {d for d, _ in after} == brute
        if name == "benchmark":
            assert after <= before and len(after) > 0.9 * len(before)
            assert not tiling.contaminated(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count()
        if name == "secrets":
            assert {d for d, _ in after} == {d for d, _ in before} and len(before - after) < 0.1 * len(before)
            assert not secrets.scan(kept).where(F.exists("spans", lambda s: s["kind"].isin("assign", "access", "hex"))).count()
            assert not kept.where(F.col("n_chars") != F.length("text")).count()
        kept = spark.createDataFrame(kept.collect(), docs.schema)


def test_pipeline_on_odd_rows(spark):
    prepare(spark)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "same words in here", "en", "s", 18), (3, "same words in here", "en", "s", 18),
            (3, "same words in here", "en", "s", 18), (4, "x " * 20_000, "en", "s", 40_000)]
    for data in (rows, []):
        out = spark.createDataFrame(data, kind)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF)
        got = {r.doc_id for r in out.collect()}
        assert got == ({1, 2, None, 3, 4} if data else set())


def test_near_duplicates_are_dropped_by_row(spark):
    """Ids of several texts, near copies under one id and under null ids."""
    prepare(spark)
    words = [[f"{g}{i}" for i in range(60)] for g in "abcdefg"]
    a, b, c, d, e, f, g = (" ".join(w) for w in words)

    def near(text):
        return text + " more"
    rows = [(1, a), (5, a), (5, b), (5, c), (6, near(c)),  # 5 copies 1, has a text of its own and names another group
            (7, d), (7, near(d)),  # near copies under one id
            (None, e), (None, e), (None, near(e)),  # a group without ids
            (None, f), (9, near(f)),  # a text without id stays beside one with
            (8, g), (8, g), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.one_per_group(spark, docs.repartition(5), SF).collect()
    pairs = [(r.doc_id, r.text) for r in got]
    assert pairs.count((None, "")) == 2 and len(pairs) == 10
    rest = {p for p in pairs if p[1]}
    assert {(1, a), (5, b), (5, c), (9, near(f)), (None, f), (8, g)} <= rest
    assert len({(7, d), (7, near(d))} & rest) == 1 and len({(None, e), (None, near(e))} & rest) == 1
    assert all(r.n_chars == len(r.text) for r in got)


def test_groups_of_null_ids_link(spark):
    text = " ".join(f"w{i}" for i in range(60))
    prepare(spark)
    df = spark.createDataFrame([(None, text), (None, text + " more"), (3, text + " else")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == {(None, 3), (3, 3)}
