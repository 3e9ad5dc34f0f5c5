"""Near-duplicate operators against all-pairs brute force on small tables."""

import random
import re

import numpy as np
import pytest

from martflow.llm import embdup, graph, neardup, queries
from martflow.llm.common import prepare

SF = "/root/testdata/sf0.01"


def brute_components(ids, linked):
    up = {i: i for i in range(len(ids))}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in linked:
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_docs(rows, k):
    sets = [shingle_set(t, k) for _, t in rows]
    links = []
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        seen = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        links += [(i, j) for j, n in seen.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    comp = brute_components([d for d, _ in rows], links)
    return sorted((str(d), len(s), str(c), str(None if d is None or c is None else d == c)) for (d, _), s, c in zip(rows, sets, comp))


def got_docs(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), str(r.kept)) for r in df.collect())


def test_documents_match_brute_force(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got_docs(queries.QUERIES["op6_minmax_dedup"](spark, SF)) == brute_docs(rows, 4)


@pytest.fixture()
def family():
    """Copies of a few texts with some words changed, and odd rows."""
    rng = random.Random(3)
    rows = []
    for base in range(3):
        words = [f"w{rng.randrange(400)}" for _ in range(150)]
        for _ in range(60):
            w = list(words)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    rows += [None, "", " \n", "one", "one", "ONE two", "one two", "a b c", "a b c d e f g h", "x " * 30_000]
    rows = [(i * 7 % 211, t) for i, t in enumerate(rows)]
    return rows + [(None, "one"), (None, "lonely words here with none alike"), rows[3], rows[3], (5000, "two texts"), (5000, "of one id")]


@pytest.mark.parametrize("bound", [(512, 10**6), (8, 700)])
def test_documents_edges_and_large_families(spark, family, bound, monkeypatch):
    """The second bound makes families of many parts out of small ones."""
    prepare(spark)
    monkeypatch.setattr(neardup, "GROUP_ROWS", bound[0])
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", bound[1])
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in family], "doc_id long, text string, n_shingles int, `class` string")
    assert got_docs(neardup.near_duplicates(df, 4)) == brute_docs(family, 4)


def test_empty_inputs(spark):
    prepare(spark)
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert embdup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("local", [500_000, 7])
def test_components_of_paths_and_hubs(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL_EDGES", local)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    want = dict(zip(nodes, brute_components(nodes, [(nodes.index(a), nodes.index(b)) for a, b in edges if a != b])))
    assert got == want


# -- vectors ----------------------------------------------------------------------

def brute_vectors(rows):
    ok, unit = [], {}
    for n, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            ok.append(n)
            x = np.array(v, dtype=np.float64)
            unit[n] = x / np.linalg.norm(x)
    links = [(i, j) for i in ok for j in ok if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    comp = brute_components([d for d, _ in rows], links)
    deg = [sum(n in x for x in links) for n in range(len(rows))]
    return sorted((str(d), n, str(c), str(d == c)) for (d, _), n, c in zip(rows, deg, comp))


def got_vectors(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), str(r.kept)) for r in df.collect())


def test_vectors_match_brute_force(spark):
    prepare(spark)
    t = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    assert got_vectors(queries.QUERIES["op2_sorted_projection_dedup"](spark, SF)) == brute_vectors([(r.vec_id, r.embedding) for r in t])


def test_vector_edges_and_groups(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(embdup, "GROUP_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = []
    for base in rng.normal(size=(3, 16)):
        rows += [[float(x) for x in np.float32(base + rng.normal(scale=0.12, size=16))] for _ in range(50)]
        rows += [[float(x) for x in np.float32(base)]] * 5
    rows += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0], [2.0, 4.0], [1.0] * 16, [3.0] * 16]
    rows = list(enumerate(rows)) + [(0, rows[0]), (0, rows[0])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<float>, rep string")
    assert got_vectors(embdup.near_duplicate_vectors(df)) == brute_vectors(rows)


@pytest.mark.parametrize("bound", [1024, 64])
def test_pairs_inside_a_dense_group(spark, monkeypatch, bound):
    """Planted links among vectors that lie just below the threshold of each
    other: too many neighbours for windows, whether compared all with all or in runs."""
    prepare(spark)
    monkeypatch.setattr(embdup, "GROUP_ROWS", bound)
    rng = np.random.default_rng(8)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)
    dense = unit(unit(rng.normal(size=128)) * 0.855 ** 0.5 + unit(rng.normal(size=(1800, 128))) * 0.145 ** 0.5)
    # some of them once more, turned by the angle of cosine 0.915
    away = rng.normal(size=(60, 128))
    away = unit(away - (away * dense[:60]).sum(axis=1, keepdims=True) * dense[:60])
    x = np.concatenate([dense, 0.915 * dense[:60] + (1 - 0.915 ** 2) ** 0.5 * away]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = unit(x.astype(np.float64))
    near = u @ u.T >= 0.9
    links = [(i, j) for i, j in np.argwhere(near).tolist() if j < i]
    assert all((1800 + i, i) in links for i in range(60)) and len(links) < 1800
    comp = brute_components(list(range(len(x))), links)
    want = sorted((str(i), int(near[i].sum()) - 1, str(c), str(i == c)) for i, c in enumerate(comp))
    assert got_vectors(embdup.near_duplicate_vectors(df)) == want


def test_passes_follow_the_number_of_classes():
    share = []
    for n in (0, 1, 5_000, 10**5, 10**7, 10**9):
        bits, passes = embdup.plan(n, 0.9, 512)
        assert n <= 512 * 2 ** bits or not bits and n < 10**4
        share.append((1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** passes)
    assert max(share) <= embdup.MISS
