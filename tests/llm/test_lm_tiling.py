"""Prediction by partial matching and string tiling against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import lmscore, queries, tiling
from martflow.llm.common import held_out, prepare

SF = "/root/testdata/sf0.001"


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(t))


def is_held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def brute_scores(rows):
    """PPM with a dictionary per context, symbol by symbol."""
    K = lmscore.ORDER
    trie, counts = [defaultdict(Counter) for _ in range(K + 1)], Counter()

    def symbols(t):
        return [lmscore.START] * K + list(fold(t).encode()) + [lmscore.END]
    for d, t in rows:
        if not is_held(d):
            s = symbols(t)
            for i in range(K, len(s)):
                for k in range(K + 1):
                    trie[k][tuple(s[i - k:i])][s[i]] += 1
            counts.update(words(t))
            counts["\n"] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        s, score = symbols(t), 0.0
        for i in range(K, len(s)):
            gone = set()
            for k in range(K, -1, -1):
                node = trie[k].get(tuple(s[i - k:i]))
                if node is None:
                    continue
                live = {x: c for x, c in node.items() if x not in gone}
                if not live:
                    continue
                whole = sum(live.values()) + len(live)
                if s[i] in live:
                    score += math.log10(live[s[i]] / whole)
                    break
                score += math.log10(len(live) / whole)
                gone |= set(node)
            else:
                score -= math.log10(lmscore.SYMBOLS - len(gone))
        tokens = words(t) + ["\n"]
        out.append((d, len(tokens), sum(counts[w] > 0 for w in tokens), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 6), round(score, 5)))
    return sorted(out, key=str)


def got_scores(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5)) for r in df.collect()), key=str)


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=lambda r: (str(r[0]), r[1], r[5])), sorted(b, key=lambda r: (str(r[0]), r[1], r[5]))):
        assert x[:4] == y[:4] and x[4] == pytest.approx(y[4], abs=1e-4) and x[5] == pytest.approx(y[5], abs=1e-3)


def test_scores_match_brute_force(spark):
    prepare(spark)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op1_ppm_score"](spark, SF)
    assert all(r.held_out == is_held(r.doc_id) for r in got.collect())
    close(got_scores(got), brute_scores(rows))


def edge_rows():
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["ab", "Ba", "abc", "ü", "x\ty"]) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(7, "copy of a copy ")] * 300 + [(None, "copy")] * 200
    return rows + [(100, None), (101, ""), (None, "ab ab"), (3, "other text"), (102, "q" * 3000), rows[4], rows[4], (103, "zz new ~ symbols \U0001F600"),
                   (104, "long words here " * 400)]


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_scores_edges(spark, monkeypatch, piece):
    prepare(spark)
    monkeypatch.setattr(lmscore, "PIECE_BYTES", piece)
    monkeypatch.setattr(lmscore, "SEEN", 20 if piece == 50 else 1000)
    monkeypatch.setattr(lmscore, "PACK", 16 if piece == 50 else 4096)
    rows = edge_rows()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, train string")
    close(got_scores(lmscore.score(df, held_out("doc_id", 7), block_bytes=2000)), brute_scores(rows))


def test_scores_without_training_or_rows(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lmscore.score(df, F.lit(True)).collect()}
    assert got[1].score == pytest.approx(-3 * math.log10(257)) and got[2].score == pytest.approx(-math.log10(257))
    assert got[1].train_tokens == 0 and got[1].n_known == 0
    assert lmscore.score(df.limit(0), F.lit(False)).count() == 0


# -- tiling ----------------------------------------------------------------------

def brute_tiling(a, b, seed):
    """Words of b covered by greedy string tiling, by plain search."""
    ma, mb, covered = [False] * len(a), [False] * len(b), 0
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n >= seed and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return covered
        n, i, j = best
        for k in range(n):
            ma[i + k] = mb[j + k] = True
        covered += n


def tokens(t):
    return [x.lower() for x in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]


def test_tiling_matches_brute_force(spark):
    prepare(spark)
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(8, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "too short"), (0, "another text under a known id with some more words")]
    docs = []
    for i in range(60):
        t = rng.choice(items[:12])[1].split()
        cut = rng.randrange(len(t))
        parts = [t[cut:], t[:cut]] if i % 2 else [t]
        noise = [f"n{rng.randrange(99)}" for _ in range(rng.randrange(20))]
        w = noise + parts[0] + noise + (parts[1] if len(parts) > 1 else [])
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = "changed"
        docs.append((i, ", ".join(w).title()))
    docs += [(100, None), (101, ""), (None, items[0][1]), docs[0], docs[0], (0, "other"), (102, "w1 " * 30_000)]
    d = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, round(r.coverage, 6)) for r in tiling.contaminated(d, b, bits=1 << 12).collect())
    want = set()
    for i, t in set(docs):
        for j, u in items:
            x, y = tokens(t), tokens(u)
            if len(x) < 5000 and len(y) >= 5 and (c := brute_tiling(x, y, 5) / len(y)) >= 0.5:
                want.add((str(i), j, round(c, 6)))
    assert got == sorted(want) and len(want) > 20
    left = tiling.clean(d, b)
    assert left.columns == d.columns
    bad = {i for i, _, _ in want}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, t in docs if str(i) not in bad or (i, t) == (0, "other"))


def test_tiling_query_finds_whole_items(spark):
    sf = "/root/testdata/sf0.01"
    prepare(spark)
    got = {r.doc_id: r for r in queries.QUERIES["op9_string_tiling"](spark, sf).collect()}
    items = [(" " + " ".join(tokens(r.text)) + " ") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
             for t in [" " + " ".join(tokens(r.text)) + " "] if any(i in t for i in items)}
    assert whole and whole <= got.keys()
    assert all(r.coverage >= 0.5 for r in got.values())


def test_tiling_empty(spark):
    prepare(spark)
    none = spark.createDataFrame([], "doc_id long, item_id long, text string")
    assert tiling.contaminated(none, none).count() == 0 and tiling.clean(none, none).count() == 0


def test_a_word_repeated_a_million_times(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(6)
    items = [(1, " ".join(["ha"] * 30)), (2, "start of it " + "ha " * 12 + "and then it ends"), (3, "ha " * 7 + "ho " + "ha " * 9 + "hu hi he"), (4, "no such words in any of them")]
    lots = lambda n: "ha " * n
    docs = [(1, lots(1_000_000)), (2, "start of it " + lots(5000) + "and then it ends"), (3, lots(3000) + "ho " + lots(4000) + "hu hi he"), (4, lots(20)), (5, "ho " + lots(9) + "x")]
    docs += [(10 + k, " ".join(rng.choice(["ho", "hu hi he", "start of it", "and then it ends", *[lots(rng.choice([3, 9, 40, 400]))] * 3]) for _ in range(6))) for k in range(12)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")

    def found(frame):
        return sorted((r.doc_id, r.item_id, round(r.coverage, 9), str(r.tiles)) for r in tiling.contaminated(frame, i, least=0.3).collect())
    got = found(d)
    assert (1, 1) in {r[:2] for r in got} and (2, 2) in {r[:2] for r in got} and (3, 3) in {r[:2] for r in got}
    monkeypatch.setattr(tiling, "_edges", lambda h, at, text, keep: np.ones(len(h), dtype=bool))
    assert found(d.where("doc_id > 1")) == [r for r in got if r[0] > 1]


def test_items_shorter_than_a_seed(spark):
    """An item of one to four words is found where a document holds all of it, in the first such place."""
    prepare(spark)
    rng = random.Random(12)
    items = [(1, "Alpha"), (2, "beta, gamma"), (3, "alpha beta alpha"), (4, "one two three four"), (5, "one two three four five"), (6, "no such"), (7, ""), (8, None),
             (9, "alpha alpha alpha alpha"), (1, "delta")]
    docs = [(1, "x alpha y ALPHA"), (2, "beta-gamma"), (3, "beta x gamma"), (4, "alpha beta alpha beta alpha"), (5, "zero one two three four"), (6, "one two three x four"),
            (7, "one two three four five"), (8, "alpha " * 100_000), (None, "beta gamma"), (2, "other"), (10, None), (11, ""), (1, "x alpha y ALPHA"), (12, "alphabet")]
    docs += [(20 + k, " ".join(rng.choice(["alpha", "beta", "gamma", "one two", "three four", "five"]) for _ in range(rng.randrange(1, 9)))) for k in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = tiling.contaminated(d, spark.createDataFrame(items, "item_id long, text string"), bits=1 << 10).collect()
    want = set()
    for i, t in set(docs):
        for j, u in items:
            x, y = tokens(t)[:1000], tokens(u)
            if y and (c := brute_tiling(x, y, min(5, len(y))) / len(y)) >= 0.5:
                want.add((str(i), t, j, round(c, 6)))
    text_of = {r.key: r.text for r in d.select(F.xxhash64("text").alias("key"), "text").collect()}
    assert sorted((str(r.doc_id), text_of[r.text_key], r.item_id, round(r.coverage, 6)) for r in found) == sorted(want) and len(want) > 50
    tiles = {(r.doc_id, r.item_id): [tuple(x) for x in r.tiles] for r in found}
    assert tiles[(1, 1)] == [(1, 0, 1)] and tiles[(2, 2)] == [(0, 0, 2)] and tiles[(4, 3)] == [(0, 0, 3)] and tiles[(5, 4)] == [(1, 0, 4)]
    assert (6, 4) not in tiles and tiles[(8, 9)] == [(0, 0, 4)] and tiles[(7, 5)] == [(0, 0, 5)]
