"""Spelling variants, conversation repair and toxicity against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import repair, toxicity, variants
from martflow.llm.common import prepare
from martflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --------------------------------------------------------------------------
# spelling variants
# --------------------------------------------------------------------------

def plain_variants(docs, least_length=6, least_count=5, every=199):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}
    masks = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "?" + w[i + 1:]].add(w)
    near = {w: set() for w in words}
    for group in masks.values():
        for a in group:
            near[a] |= group - {a}
    for w in words:
        for i in range(len(w)):
            if (less := w[:i] + w[i + 1:]) in words:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def test_variants_on_whole_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op11_permuterm_variants"](spark, SF))
    assert got == plain_variants(docs)
    assert sum(1 for r in got if r[1]) > 5 and len(got) > 1000


def test_variants_edges(spark):
    rnd = random.Random(5)
    base = ["aaaaaaa", "aaaaaaab", "aaaabaaa", "aaaaaaaa", "éclairsé", "éclairse", "ÀÀbcdefg", "bcdefgh", "abcdefgh", "abcdefg", "xabcdefg", "zabcdefg"]
    docs = [(None, None), (1, ""), (2, "12 ..."), (3, "SHORT word"), (None, "Orphan orphan ORPHAN orphan orphan")]
    for k in range(400):
        docs.append((rnd.choice([k, 7, None]), " ".join(rnd.choice(base[:1 + rnd.randrange(len(base))]) for _ in range(8))))
    docs += [(9, "lengthy " * 400_000)] + [(11, "repeated row here repeated")] * 3  # beyond one piece; repeated rows
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    assert rows(variants.spelling_variants(df, every=7)) == plain_variants(docs, every=7)
    assert variants.spelling_variants(df.limit(0)).collect() == []
    # a cut never parts a run, also not between a letter's bytes
    text = ("é" * 1_100_000 + " " + "a" * 50).encode()
    assert b"".join(variants._cut(text)) == text and len(list(variants._cut(text))) == 2


def test_variants_chain_of_forms(spark):
    chain = [("aaaaaab", 5), ("aaaaabb", 25), ("aaaabbb", 125), ("aaabbbb", 625)]
    df = spark.createDataFrame([(1, " ".join(" ".join([w] * n) for w, n in chain))], "doc_id long, text string")
    got = {r.word: r for r in variants.spelling_variants(df, every=1 << 40).collect()}
    assert [got[w].root for w, _ in chain] == ["aaabbbb"] * 4
    assert [got[w].form for w, _ in chain] == ["aaaaabb", "aaaabbb", "aaabbbb", None]


# --------------------------------------------------------------------------
# conversation repair
# --------------------------------------------------------------------------

SPACE = " \t\n\v\f\r"


def plain_edits(seq):
    """Cheapest (cost, edits) by working backwards over (row, last role)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {(len(seq), q): (0, "") for q in ("", "a")}
    for i in range(len(seq), -1, -1):
        here = {q: best.get((i, q), (1 << 40, "~")) for q in after}
        if i < len(seq):
            role, fault = seq[i]
            for q in after:
                cost, path = best[i + 1, q]
                ways = [here[q], (cost + 3, "D" + path)]
                if fault not in ("blank", "duplicate"):
                    cut = fault == "truncated"
                    ways += [(best[i + 1, c][0] + cut, "K" + best[i + 1, c][1]) for c in after[q] if c == role]
                    ways += [(best[i + 1, c][0] + cut + 2, "R" + best[i + 1, c][1]) for c in after[q] if c != "s"]
                here[q] = min(ways)
        for _ in range(3):
            for q in after:
                here[q] = min([here[q], *((here[c][0] + 2, "I" + here[c][1]) for c in after[q] if c != "s")])
        best |= {(i, q): v for q, v in here.items()}
    return best[0, ""]


def plain_repair(ids, convs):
    out = []
    for cid in ids:
        seq, seen = [], set()
        ordered = sorted(convs.get(cid, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        for _, role, text in ordered:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else \
                "truncated" if text.strip(SPACE)[-1] not in ".!?" else ""
            seen.add((role, text))
            seq.append((role[:1], fault))
        turns = [t for t, _, _ in ordered if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(f for _, f in seq)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:]))
        cost, path = plain_edits(seq)
        lines, last, k = [], "", 0
        for e in path:
            role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if e == "I":
                lines.append(f"{role}:")
                last = role[0]
                continue
            _, own, text = ordered[k]
            k += 1
            if e != "D":
                role = own if e == "K" else role
                lines.append(f"{role}:{text}")
                last = role[0]
        assert k == len(ordered)
        out.append((cid, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, path, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def plain_damage(data):
    convs = defaultdict(list)
    for cid, turn, role, text in data:
        role, text = (" " if x is None else x for x in (role, text))
        c = zlib.crc32(f"{' ' if cid is None else cid}:{' ' if turn is None else turn}".encode()) % 20
        if c == 0:
            continue
        text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
        convs[cid] += [(turn, "user" if c == 4 else role, text)] * (2 if c == 3 else 1)
    return convs


def test_repair_on_whole_conversations(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows(QUERIES["op12_conversation_repair"](spark, SF))
    assert got == plain_repair({r[0] for r in data}, plain_damage(data))
    assert sum("I" in r[7] for r in got) > 5 and sum("D" in r[7] for r in got) > 5


def repaired(spark, df, whole=None):
    audited = repair.audits(df).persist()
    return rows(repair.digest(repair.apply(df, audited), audited, df if whole is None else whole))


def test_repair_edges(spark):
    rnd = random.Random(3)
    texts = ["Fine.", "Yes!", "cut off", "", " \t", "Why?", "Fine. ", "é", None]
    data = [(k % 60 if k % 7 else None, rnd.choice([None, *range(9)]), rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Assistant", "sys"]),
             rnd.choice(texts)) for k in range(700)]
    data += [(100, 1, "user", "same.")] * 40  # repeated rows
    data += [(101, None, "user", "no turn."), (101, None, "assistant", "none.")]
    data += [(102, 10 ** 12, "user", "x" * 3_000_000 + " " * 100_000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("x")).withColumn("h", F.lit(1))
    convs = defaultdict(list)
    for cid, turn, role, text in data:
        convs[cid].append((turn, " " if role is None else role, " " if text is None else text))
    assert repaired(spark, df) == plain_repair(set(convs), convs)
    assert repaired(spark, df.limit(0)) == []
    # nothing left of a conversation: zeros and the hash of nothing
    gone = repaired(spark, df.limit(0), df.where("conv_id = 100"))
    assert gone == [(100, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_long_conversation_is_searched_in_blocks(spark):
    rnd = random.Random(4)
    data = [(1, k if k % 50 else k - 1, rnd.choice(["user", "assistant"]) if rnd.random() < .2 else ("user", "assistant")[k % 2], rnd.choice(["no", "yes."]) + str(k) * (k % 3) + ".") for k in range(2000)]
    data += [(1, 77, "user", "copy")] * 700 + [(2, 0, "user", "a."), (3, 5, "assistant", "b.")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)
    convs = defaultdict(list)
    for cid, *r in data:
        convs[cid].append(tuple(r))
    assert repaired(spark, df) == plain_repair(set(convs), convs)


def test_search_finds_the_first_of_the_cheapest():
    rnd = random.Random(1)
    name = {repair.FINE: "", repair.FORCED: "blank", repair.CUT: "truncated"}
    for _ in range(1500):
        seq = [(rnd.choice(["s", "u", "u", "a", "a", "x", ""]), rnd.choice([0, 0, 0, 1, 2])) for _ in range(rnd.randint(0, 12))]
        want = plain_edits([(c, name[k]) for c, k in seq])
        assert repair.cheapest(seq) == want
        # the estimate never exceeds the true cost
        assert repair.Search(seq, (repair.START, repair.A)).least(0, repair.START) <= want[0]


# --------------------------------------------------------------------------
# toxicity
# --------------------------------------------------------------------------

def invented(seed=2, n=900):
    rnd = random.Random(seed)
    part = ["ra", "lo", "mi", "ten", "sho", "ve", "gar", "un", "pi", "dos"]
    word = lambda: "".join(rnd.choice(part) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for k in range(n):
        words = [word() for _ in range(rnd.choice([8, 60, 400]))]
        bad = k % 4 == 0
        if bad:
            for _ in range(2 + len(words) // 60):
                w = rnd.choice(["idiot", "scumbag"]) + rnd.choice(["", "ic", "en", "os"])
                words.insert(rnd.randrange(len(words)), w)
        docs.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return docs, labels


def test_toxicity_held_out_and_unseen_spellings(spark):
    docs, labels = invented()
    docs += [(5000, "ra lo idi0t scumbagging mi idiotz"), (5001, None), (5002, ""), (5003, "123 !!"), (None, "idiotic scumbags idiot"), (5004, "ra lo mi ten")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("score", F.lit("x"))
    lab = spark.createDataFrame([*labels, (None, 1), (1, None), (7, 0)], "doc_id long, toxic int").withColumn("text", F.lit("idiot"))
    train = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(False))
    got = {r.doc_id: r for r in toxicity.score(d, lab, train, per_label=300).collect()}
    told = dict(labels)
    held = [k for k in told if k % 5 == 0]
    assert np.mean([got[k].predicted == told[k] for k in held]) > 0.95
    assert got[5000].predicted == 1 and got[None].predicted == 1  # misspelt, never seen
    assert {got[k].predicted for k in (5001, 5002, 5003, 5004)} == {0}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_toxicity_sample_is_bounded_in_rows(spark):
    rnd = random.Random(9)
    docs = [(3, f"hot {rnd.random()}") for _ in range(3000)] + [(k, f"text {k}") for k in range(100)]
    labels = [(k, k % 2) for k in range(100)] + [(3, 0)] * 50
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.sample(d, lab, F.lit(True), 20).collect()
    assert len(got) <= 40 and Counter(r.label for r in got) == {0: 20, 1: 20}
    assert len(toxicity.sample(d, lab, F.lit(True), 500).collect()) == 100  # the hot id teaches once


def test_toxicity_without_labels(spark):
    d = spark.createDataFrame([(1, "idiot"), (1, "idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.score(d, none, F.lit(True)).collect()] == [(0.0, 0)] * 2
    assert toxicity.score(d.limit(0), none, F.lit(True)).collect() == []


def test_toxicity_pieces_cover_whole_texts():
    text = np.frombuffer(b"abc de " * 400_000, dtype=np.uint8)
    offsets = np.array([0, 10, 10, len(text)])
    at, owner = toxicity.pieces(text, offsets)
    assert at[0] == 0 and at[-1] == len(text) and owner.tolist()[0] == 0 and set(owner.tolist()) == {0, 2}
    assert max(np.diff(at)) <= toxicity.SLICE + 8 and all(text[i] in b" " for i in at[2:-1])
    whole = sum(len(toxicity.distinct_words(text[i:j], np.array([0, j - i]))[2]) for i, j in zip(at[1:-1], at[2:]))
    assert whole == 2 * (len(at) - 2) + (text[10:13].tobytes() not in (b"abc", b" de"))
