"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent in numpy.

Features are the byte 2-, 3- and 4-grams of the lower-cased text, white space
taken as one boundary byte, hashed into ``BUCKETS`` embeddings of ``DIM``
numbers. A text is the average of its embeddings; a linear layer and softmax
give the language. The model is fitted on a bounded sample of labelled rows
(``per_lang`` distinct rows of each language, chosen by hashes of id and text); its size is
fixed by ``BUCKETS``. Probabilities are calibrated by one temperature fitted on
a part of the sample that SGD doesn't see, and ``rejected`` marks predictions
whose probability lies below the one that all but ``reject_rate`` of the right
ones in that part reach.

Prediction reads whole texts in slices: the embedding and the linear layer are
multiplied out once, so each n-gram adds one row of ``len(langs)`` numbers.

Defined results: a null text or one without a letter is ``und`` with score 0
and rejected; a null language is no label; with no labelled row every text is
``und``; an empty table gives an empty table; repeated rows each give a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import LOWER, SPACE, raw, slices

BUCKETS = 1 << 15
DIM = 16
GRAMS = (2, 3, 4)
UND = "und"
_LETTER = regex.compile(r"\p{L}")
_FOLD = LOWER.copy()
_FOLD[SPACE] = 0x20


def features(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (the last n - 1 wrap into zeros)."""
    b = _FOLD[data].astype(np.uint32)
    h = np.full(len(b), n, dtype=np.uint32)
    for j in range(n):
        part = np.zeros(len(b), dtype=np.uint32)
        part[:len(b) - j] = b[j:]
        h = h * np.uint32(0x01000193) ^ part * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return (h >> np.uint32(32 - 15)).astype(np.int32)


def _starts(offsets: np.ndarray, n: int, size: int) -> np.ndarray:
    """1 where an n-gram starting here ends inside its text."""
    ok = np.ones(size, dtype=np.float32)
    for j in range(1, n):
        at = offsets[1:] - j
        ok[at[at >= offsets[:-1]]] = 0
    return ok


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x langs: embedding times linear layer
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Averaged logits of each text of a slice."""
        n, k = len(offsets) - 1, len(self.langs)
        total, count = np.zeros((n, k)), np.zeros(n)
        if len(data):
            full = np.flatnonzero(np.diff(offsets) > 0)
            for g in GRAMS:
                ok = _starts(offsets, g, len(data))
                rows = self.table[features(data, g)] * ok[:, None]
                total[full] += np.add.reduceat(rows, offsets[:-1][full], axis=0, dtype=np.float64)
                count[full] += np.add.reduceat(ok, offsets[:-1][full], dtype=np.float64)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _counts(batches):
    """Task of the sample: (lang, row, distinct buckets, their counts) of each text,
    as packed bytes (six for each bucket that occurs)."""
    for b in batches:
        data, offsets = raw(b.column(2))
        idx, cnt = [], []
        for i in range(b.num_rows):
            d = data[offsets[i]:offsets[i + 1]]
            f = np.concatenate([features(d, n)[:max(0, len(d) - n + 1)] for n in GRAMS])
            u, c = np.unique(f, return_counts=True)
            idx.append(u.astype("<u2").tobytes())
            cnt.append(c.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(idx, pa.binary()), pa.array(cnt, pa.binary())],
                                         names=["lang", "row", "idx", "cnt"])


#: First ranking of the sample: parts of a language that are ranked apart.
LOTS = 64


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, train, per_lang: int) -> DataFrame:
    """(lang, idx, cnt) of ``per_lang`` rows of each language at most: those with
    the smallest (id hash, text hash) among the distinct rows where ``train`` holds.

    A language's rows are ranked in LOTS parts first, so that the task that ranks
    the parts' best has LOTS * per_lang narrow rows at most."""
    src = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != "")) \
        .select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    place = [F.xxhash64(F.lit(17), "id").alias("h"), F.xxhash64("text").alias("t")]
    narrow = src.select("lang", "id", *place).distinct()
    lot = narrow.withColumn("lot", F.pmod(F.xxhash64("h", "t"), F.lit(LOTS)))
    order = ["h", "id", "t"]
    some = lot.withColumn("r", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(F.col("r") <= per_lang).drop("r")
    best = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= per_lang)
    chosen = best.select(F.col("lang").alias("of"), F.col("id").alias("i"), F.col("t").alias("k"))  # per_lang rows of each language
    on = (F.col("lang") == F.col("of")) & F.col("id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("k"))
    rows = src.join(F.broadcast(chosen), on).select("lang", F.xxhash64("id", "text").alias("row"), "text")
    kept = rows.mapInArrow(_counts, "lang string, row long, idx binary, cnt binary")
    # equal rows are one
    one = kept.groupBy("lang", "row").agg(F.min(F.struct("idx", "cnt")).alias("r"))
    return one.select("lang", "r.idx", "r.cnt")


def fit(rows: list, epochs: int = 6, rate: float = 0.5, seed: int = 11, reject_rate: float = 0.01) -> Model | None:
    """SGD over the collected sample (bounded by :func:`sample`)."""
    rows = sorted(((r["lang"], np.frombuffer(r["idx"], "<u2"), np.frombuffer(r["cnt"], "<u4")) for r in rows if r["idx"]),
                  key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    rng = np.random.Generator(np.random.PCG64(seed))
    emb = rng.normal(0, 0.3, (BUCKETS, DIM))
    lin, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    order = rng.permutation(len(rows))
    checked = order[:len(rows) // 5] if len(rows) >= 20 else order
    learned = order[len(rows) // 5:] if len(rows) >= 20 else order
    y = np.array([langs.index(r[0]) for r in rows])
    # languages weigh alike, however many rows they have
    weight = np.array([len(learned) / (len(langs) * max(1, (y[learned] == k).sum())) for k in range(len(langs))])
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for i in rng.permutation(learned):
            _, idx, cnt = rows[i]
            part = cnt / cnt.sum()
            x = part @ emb[idx]
            z = x @ lin + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(weight[y[i]], 10.0)
            back = lin @ p
            lin -= step * np.outer(x, p)
            bias -= step * 0.1 * p
            emb[idx] -= step * 20 * part[:, None] * back
    table = emb @ lin
    z = np.array([(rows[i][2] / rows[i][2].sum()) @ table[rows[i][1]] + bias for i in checked])
    yc = y[checked]

    def loss(t):
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return -(s[np.arange(len(yc)), yc] - np.log(np.exp(s).sum(axis=1))).mean()

    temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    model = Model(langs, table.astype(np.float32), bias, temperature, 0.0)
    p = model.probabilities(z)
    right = p[p.argmax(axis=1) == yc].max(axis=1) if (p.argmax(axis=1) == yc).any() else np.zeros(1)
    model.least = float(np.quantile(right, reject_rate))
    return model


def identify(docs: DataFrame, train, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             per_lang: int = 500, epochs: int = 6) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang_pred``, ``score`` (its
    calibrated probability), ``rejected``. ``train``: which rows may be learned
    from. Fits on ``per_lang`` rows of each language at most."""
    spark = docs.sparkSession
    model = fit(sample(docs, doc_id, text, lang, train, per_lang).collect(), epochs)
    held = spark.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def task(batches):
        m = held.value
        for b in batches:
            col = b.column(1)
            data, offsets = raw(col)
            letters = np.array([bool(t and _LETTER.search(t)) for t in col.to_pylist()], dtype=bool)
            pred, score = [UND] * b.num_rows, np.zeros(b.num_rows)
            if m is not None:
                for i, j in slices(offsets, 1 << 20):
                    p = m.probabilities(m.logits(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                    best = p.argmax(axis=1)
                    for k in np.flatnonzero(letters[i:j]):
                        pred[i + k] = m.langs[best[k]]
                        score[i + k] = p[k, best[k]]
            least = m.least if m is not None else 1.0
            bad = (score < least) | ~letters
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(bad)],
                                             names=["doc_id", "lang_pred", "score", "rejected"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(task, f"doc_id {src.schema[0].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
