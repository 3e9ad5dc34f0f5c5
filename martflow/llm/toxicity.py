"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is a run of letters and digits (bytes above 127 count as letters), A-Z
lower-cased; its subwords are the byte 3- to 6-grams of ``<word>``, marks
included, hashed into ``BUCKETS`` embeddings of ``DIM`` numbers. A text is the
average of its subwords' embeddings, in which a word that occurs c times weighs
1 + ln(c) and ``NEUTRAL`` subwords without meaning are added, so that neither a
repeated word nor a few short ones decide alone. A linear layer and softmax over
the two labels give the score. Embeddings and layer are trained together by
stochastic gradient descent (Adagrad steps) in numpy. A misspelling that training
never saw shares most of its subwords with the word it was made from; subwords
of fewer than ``MIN_BAGS`` training texts stay neutral.

Fitting sees a bounded sample: of each label the ``per_label`` document ids with
the smallest hashes, one text of each id, and of a text at most ``MAX_GRAMS``
distinct subwords (those of the smallest hashed order). So the driver holds
``2 * per_label * MAX_GRAMS`` packed counts at most, whatever the corpus. A fifth
of the sample is kept from SGD; a scale and a shift fitted on it turn the
softmax's margin into the score, so that 0.5 parts the labels best.

Scoring reads whole texts in slices. Embedding and layer are multiplied out
once, so a subword adds one number. A text beyond ``SLICE`` bytes is read in
pieces cut between words, and its words are weighed piece by piece.

Defined results: a null or empty text, or one without a word, has the margin of
the empty bag, which is the shift alone; null labels and null ids teach nothing;
an id with several labels counts as toxic if one of them is 1; of several texts
of an id the one with the smallest hash teaches, and each row gets its score;
with no labelled row, or one label only, every score is 0; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import NO_WORD, Words, raw, slices

BITS = 18
BUCKETS = 1 << BITS
DIM = 8
GRAMS = (3, 4, 5, 6)
MAX_GRAMS = 1 << 14
NEUTRAL = 600
MIN_BAGS = 10
SLICE = 1 << 20

_MARK = 0x20


def subwords(data: np.ndarray, offsets: np.ndarray):
    """For each n: (bucket, position) of the subwords of words laid end to end,
    lower-cased already. Each word stands between two marks, so position counts
    bytes of the marked words: word k starts at ``offsets[k] + k``."""
    n_words = len(offsets) - 1
    b = np.full(len(data) + n_words + 1, _MARK, dtype=np.uint8)
    b[np.arange(len(data)) + np.repeat(np.arange(n_words) + 1, np.diff(offsets))] = data
    inner = np.concatenate(([0], np.cumsum(b == _MARK)))  # marks before each byte
    wide = b.astype(np.uint32)
    h = np.full(len(b), 0x811C9DC5, dtype=np.uint32)
    for n in range(1, GRAMS[-1] + 1):
        size = len(b) - n + 1
        if size <= 0:
            return
        h = (h[:size] ^ wide[n - 1:]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(13)
        if n in GRAMS:
            # no mark but at the first and last byte: within one word
            at = np.flatnonzero(inner[n - 1:len(b)][:size] == inner[1:size + 1])
            x = (h[at] + np.uint32(n)) * np.uint32(0x9E3779B1)
            x ^= x >> np.uint32(15)
            yield (x * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)).astype(np.int32), at


def distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bounds, text, weight) of the distinct words of each text of a slice."""
    w = Words(data, offsets, NO_WORD)
    h = w.hashes()
    order = np.lexsort((h, w.text))
    h, text = h[order], w.text[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(h)))
    start, end = w.start[order[first]], w.end[order[first]]
    bounds = np.concatenate(([0], np.cumsum(end - start)))
    at = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], end - start)
    return w.bytes[at], bounds, text[first], 1 + np.log(np.maximum(count, 1))


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, text) with texts of more than SLICE bytes cut between words."""
    big = np.flatnonzero(np.diff(offsets) > SLICE)
    if not len(big):
        return offsets, np.arange(len(offsets) - 1)
    cuts = []
    for k in big:
        lo, edge = offsets[k], offsets[k] + np.flatnonzero(NO_WORD[data[offsets[k]:offsets[k + 1]]])
        while offsets[k + 1] - lo > SLICE:
            i = np.searchsorted(edge, lo + SLICE)
            if i == len(edge) or edge[i] >= offsets[k + 1]:
                break
            lo = edge[i]
            cuts.append(lo)
    at = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], cuts, offsets[-1:]))).astype(np.int64)
    return at, np.searchsorted(offsets, at[:-1], side="right") - 1


def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of one text's subwords, MAX_GRAMS of them at most."""
    total = np.zeros(BUCKETS)
    at, _ = pieces(data, np.array([0, len(data)]))
    for lo, hi in zip(at[:-1], at[1:]):
        letters, bounds, _, weight = distinct_words(data[lo:hi], np.array([0, hi - lo]))
        for f, pos in subwords(letters, bounds):
            word = np.searchsorted(bounds[:-1] + np.arange(len(weight)), pos, side="right") - 1
            total += np.bincount(f, weights=weight[word], minlength=BUCKETS)
    idx = np.flatnonzero(total)
    if len(idx) > MAX_GRAMS:
        order = np.argsort(idx.astype(np.uint32) * np.uint32(0x9E3779B1), kind="stable")
        idx = np.sort(idx[order[:MAX_GRAMS]])
    return idx, total[idx]


def sample(docs: DataFrame, labels: DataFrame, train: Column, per_label: int, doc_id: str = "doc_id", text: str = "text",
           label: str = "toxic") -> DataFrame:
    """(label, idx, cnt) of ``per_label`` documents of each label at most, one
    row of each chosen id. ``train``: which rows of ``labels`` may be used."""
    told = labels.where(train & F.col(doc_id).isNotNull() & F.col(label).isNotNull()) \
        .groupBy(F.col(doc_id).alias("id")).agg(F.max((F.col(label) == 1).cast("int")).alias("label")) \
        .withColumn("h", F.xxhash64(F.lit(29), "id"))
    chosen = None
    for k in (0, 1):
        # a hash bound leaves a little more than per_label ids to be ordered
        of = told.where(F.col("label") == k)
        n = of.count()
        if n > 4 * per_label:
            of = of.where(F.shiftrightunsigned("h", 32) < int((1.5 * per_label / n) * (1 << 32)))
        of = of.orderBy("h", "id").limit(per_label)
        chosen = of if chosen is None else chosen.unionByName(of)
    src = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = src.where(F.col("text").isNotNull()).join(F.broadcast(chosen.select("id", "label")), "id")  # 2 * per_label rows at most

    def task(batches):
        for b in batches:
            data, offsets = raw(b.column(3))
            idx, cnt = [], []
            for i in range(b.num_rows):
                u, c = bag(data[offsets[i]:offsets[i + 1]])
                idx.append(u.astype("<u4").tobytes())
                cnt.append(c.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(idx, pa.binary()), pa.array(cnt, pa.binary())],
                                             names=["id", "h", "label", "idx", "cnt"])

    kind = src.schema["id"].dataType.simpleString()
    bags = rows.select("id", F.xxhash64("text").alias("h"), "label", "text") \
        .mapInArrow(task, f"id {kind}, h long, label int, idx binary, cnt binary")
    one = bags.groupBy("id").agg(F.min(F.struct("h", "label", "idx", "cnt")).alias("r"))
    return one.select("r.label", "r.idx", "r.cnt")


@dataclass
class Model:
    table: np.ndarray  # BUCKETS: embedding times the layer's margin
    scale: float
    shift: float

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Averaged margin of each text."""
        n = len(offsets) - 1
        cut, owner = pieces(data, offsets)
        total, count = np.zeros(n), np.zeros(n)
        for i, j in slices(cut, SLICE):
            letters, bounds, text, weight = distinct_words(data[cut[i]:cut[j]], cut[i:j + 1] - cut[i])
            text = owner[i:j][text]
            first = bounds[:-1] + np.arange(len(weight))
            for f, at in subwords(letters, bounds):
                upto = np.concatenate(([0.0], np.cumsum(self.table[f], dtype=np.float64)))
                lo = np.searchsorted(at, np.append(first, len(letters) + len(weight)))
                total += np.bincount(text, weights=np.diff(upto[lo]) * weight, minlength=n)
                count += np.bincount(text, weights=np.diff(lo) * weight, minlength=n)
        return total / (count + NEUTRAL)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margins + self.shift, -60, 60)))


def fit(rows: list, epochs: int = 25, rate: float = 0.2, seed: int = 13) -> Model | None:
    """SGD over the collected sample (bounded by :func:`sample`)."""
    rows = sorted((r for r in rows if r["idx"]), key=lambda r: (r["label"], r["idx"], r["cnt"]))
    y = np.array([r["label"] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.Generator(np.random.PCG64(seed))
    emb = np.zeros((BUCKETS, DIM), dtype=np.float32)  # subwords never seen stay neutral
    lin = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    seen, seen_lin = np.full(BUCKETS, 1e-8, dtype=np.float32), np.full((DIM, 2), 1e-8, dtype=np.float32)
    order = rng.permutation(len(rows))
    cut = len(rows) // 5 if len(rows) >= 40 else 0
    learned, checked = order[cut:], order[:cut] if cut else order
    # labels weigh alike, however many rows they have
    weight = np.array([len(learned) / (2 * max(1, (y[learned] == k).sum())) for k in (0, 1)])
    often = np.zeros(BUCKETS, dtype=np.int64)
    for i in learned:
        often[np.frombuffer(rows[i]["idx"], "<u4")] += 1
    known = often >= min(MIN_BAGS, max(1, len(learned) // 50))  # rarer ones stay neutral
    grams, parts = [], []
    for r in rows:
        idx, cnt = np.frombuffer(r["idx"], "<u4"), np.frombuffer(r["cnt"], "<f4")
        use = known[idx]
        grams.append(idx[use].astype(np.int32))
        parts.append(cnt[use] / np.float32(cnt.sum(dtype=np.float64) + NEUTRAL))
    for _ in range(epochs):
        for i in rng.permutation(learned):
            idx, part = grams[i], parts[i]
            x = part @ emb[idx]
            z = x @ lin
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= np.float32(weight[y[i]])
            back = lin @ p
            g = np.outer(x, p)
            seen_lin += g * g
            lin -= np.float32(rate) * g / np.sqrt(seen_lin)
            seen[idx] += part * part * (back @ back)
            emb[idx] -= (np.float32(rate) * part / np.sqrt(seen[idx]))[:, None] * back
    table = emb @ (lin[:, 1] - lin[:, 0])
    m = np.array([parts[i] @ table[grams[i]] for i in checked], dtype=np.float64)
    return Model(table.astype(np.float32), *_calibrated(m, y[checked]))


def _calibrated(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(scale, shift): 0.5 at the cut with the fewest errors, labels weighing
    alike, midway between the margins on its sides; the scale has the spread of
    the margins about the cut at one unit."""
    order = np.argsort(m, kind="stable")
    m, y = m[order], y[order]
    ones, zeros = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    # errors of a cut before position k: toxic ones below it, clean ones above
    errors = np.concatenate(([0], np.cumsum(y))) / ones + (zeros - np.concatenate(([0], np.cumsum(1 - y)))) / zeros
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    k = int(best[len(best) // 2])
    low, high = m[max(0, k - 1)], m[min(k, len(m) - 1)]
    cut = (low + high) / 2
    spread = float(np.median(np.abs(m - cut))) or 1.0
    return 3 / spread, -3 * float(cut) / spread


def score(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          per_label: int = 1500, epochs: int = 25) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` (0 to 1) and
    ``predicted`` (1 where the score is 0.5 or more). Only ``labels`` rows for
    which ``train`` holds teach."""
    spark = docs.sparkSession
    model = fit(sample(docs, labels, train, per_label, doc_id, text, label).collect(), epochs)
    held = spark.sparkContext.broadcast(model)  # BUCKETS numbers

    def task(batches):
        m = held.value
        for b in batches:
            data, offsets = raw(b.column(1))
            out = np.zeros(b.num_rows)
            if m is not None:
                out = m.scores(m.margins(data, offsets))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), pa.array((out >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(task, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
