"""Language-model scores: prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, counted over the
training documents, with escapes by method C (an escape weighs as much as the
context's distinct symbols) and symbol exclusion (symbols of the longer context
no longer count in the shorter one). A document is its bytes, A-Z lower-cased,
and an end symbol, after ``ORDER`` start symbols; its score is the log10
probability of that. Below the empty context, symbols never seen are alike.

Because every symbol seen after a context is also seen after the context's
suffix, what is excluded in a context depends only on the next longer context
that occurs; so a symbol's probability is a function of its last ORDER + 1
symbols, and the trie is a table per depth, sharded by context:

1. Whole texts are dealt into blocks of about ``BLOCK_BYTES`` (long ones in
   pieces cut at white space; rows that a scan task meets again are counted, not
   sent again). A block names the distinct (ORDER + 1)-grams and words that it
   holds, with their counts in training documents.
2. These rows, summed by key, are the trie's deepest level and the word counts;
   levels above are sums of levels below. Grams that training documents hold
   get their probability from their context's row; the others escape level by
   level through joins.
3. The values go back to the blocks that asked for them, packed. A block's values
   come first and its pieces after them in one sorted stream, so a task holds a
   block's part of the model and one slice of texts, however many blocks it gets.

Nothing of the model passes through the driver or is broadcast, and the rows
that a block asks for don't grow with the corpus.

Defined results: a null text is an empty one, whose only symbol and token is
the end; a null id is a training row; repeated rows are counted and scored each;
with no training rows all symbols are alike; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .graph import attach
from .words import LOWER, SPACE, Words, raw

ORDER = 4
END, START = 256, 257
SYMBOLS = 257  # bytes and the end
BITS = 9
BLOCK_BYTES = 32 << 20
PIECE_BYTES = 1 << 18
#: Bytes of texts that a task works on at a time.
SLICE = 1 << 19
#: Distinct keys that a block collects before it merges them.
MERGE = 1 << 20
#: Values in a packed row, and values that a task holds to pack them.
PACK, PACK_ROWS = 1 << 12, 1 << 20
#: Rows of which a scan task remembers that it has sent them.
SEEN = 100_000


def grams(data: np.ndarray, offsets: np.ndarray, heads: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): for each piece the code of the ORDER + 1 symbols that
    end at each of its bytes, and at its end if it is ``last`` of its text.
    ``heads``: the ORDER symbols before each piece."""
    n = len(offsets) - 1
    sizes = np.diff(offsets) + last
    width = sizes + ORDER
    at = np.concatenate(([0], np.cumsum(width)))
    sym = np.empty(at[-1], dtype=np.int64)
    sym[at[:-1, None] + np.arange(ORDER)] = heads
    sym[np.arange(len(data)) + np.repeat(at[:-1] + ORDER - offsets[:-1], np.diff(offsets))] = LOWER[data]
    sym[at[1:][last] - 1] = END
    code = sym[:len(sym) - ORDER].copy()
    for j in range(1, ORDER + 1):
        code <<= BITS
        code |= sym[j:len(sym) - ORDER + j]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    keep = np.arange(bounds[-1]) + np.repeat(np.arange(n) * ORDER, sizes)
    return code[keep], bounds


def word_keys(w: Words) -> np.ndarray:
    """Negative longs, so that they never meet a gram's code."""
    return (w.hashes() | np.uint64(1 << 63)).view(np.int64)


def _cut(d: np.ndarray) -> list[int]:
    """Bounds of a text's pieces."""
    cut = [0]
    while len(d) - cut[-1] > PIECE_BYTES:
        rest = np.flatnonzero(SPACE[d[cut[-1] + PIECE_BYTES:]])
        if not len(rest):
            break
        cut.append(int(cut[-1] + PIECE_BYTES + rest[0]))
    return [*cut, len(d)]


def _pieces(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, doc_id, row_key, piece, last, train, head, text, n). A row that a
    task has just sent comes again without text, as a count ``n`` for each of
    its pieces."""
    def task(batches):
        rows: list = []
        seen: dict = {}
        names = ["doc_id", "row_key", "piece", "last", "train", "head", "text", "n"]
        kind = None

        def out():
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = [kind, pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        def again():
            for (doc_id, row_key), (train, count, n) in seen.items():
                rows.extend((doc_id, row_key, p, p == count - 1, train, None, None, n) for p in range(count) if n)
            seen.clear()

        for b in batches:
            kind = b.schema.field(0).type
            data, offsets = raw(b.column(3))
            ids, keys, train = (b.column(k).to_pylist() for k in range(3))
            size = 0
            for k in range(b.num_rows):
                if (have := seen.get((ids[k], keys[k]))) is not None:
                    have[2] += 1
                    continue
                d = data[offsets[k]:offsets[k + 1]]
                cut = _cut(d)
                seen[ids[k], keys[k]] = [train[k], len(cut) - 1, 0]
                for p, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
                    rows.append((ids[k], keys[k], p, p == len(cut) - 2, train[k], d[max(0, lo - ORDER):lo].tobytes() if p else b"", d[lo:hi].tobytes(), 1))
                    size += hi - lo
                if size > 8 * SLICE:
                    yield out()
                    rows.clear()
                    size = 0
            if len(seen) > SEEN:
                again()
            yield out()
            rows.clear()
        again()
        if rows:
            yield out()

    src = docs.select("doc_id", F.xxhash64("doc_id", "text", "train").alias("row_key"), "train", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    cut = src.mapInArrow(task, f"doc_id {kind}, row_key long, piece int, last boolean, train boolean, head binary, text binary, n long")
    return cut.withColumn("block", F.pmod(F.xxhash64("row_key", "piece"), F.lit(blocks)).cast("int"))


class _Slice:
    """Distinct pieces of a block, worked on together."""

    def __init__(self):
        self.rows: list = []  # doc_id, row_key, piece, last, train, head, text, n
        self.size = 0

    def add(self, row: list) -> None:
        if self.rows and self.rows[-1][:3] == row[:3]:
            mine = self.rows[-1]
            mine[7] += row[7]
            if mine[6] is None:
                mine[5:7] = row[5:7]
                self.size += len(row[6] or b"")
            return
        self.rows.append(row)
        self.size += len(row[6] or b"")

    def taken(self) -> list:
        rows, self.rows, self.size = self.rows, [], 0
        return rows


def _arrays(rows: list):
    """(bytes, offsets, heads, last) of a slice."""
    data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(r[6]) for r in rows]))).astype(np.int64)
    heads = np.full((len(rows), ORDER), START, dtype=np.int64)
    for k, r in enumerate(rows):
        if r[5]:
            heads[k, ORDER - len(r[5]):] = LOWER[np.frombuffer(r[5], np.uint8)]
    return data, offsets, heads, np.array([r[3] for r in rows], dtype=bool)


def _walk(batches, columns: list[str], on_slice, on_block, on_row=None):
    """Streams sorted rows: ``on_slice(rows)`` for slices of a block's pieces,
    ``on_block(block)`` behind each block, ``on_row`` for rows of values. All
    yield record batches."""
    now, part = None, _Slice()
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in columns]
        for block, *row in zip(*cols):
            if block != now:
                if now is not None:
                    if rows := part.taken():
                        yield from on_slice(rows)
                    yield from on_block(now)
                now = block
            if on_row is not None and row[8] is not None:
                on_row(row[8], row[9])
                continue
            if part.size >= SLICE and part.rows and part.rows[-1][:3] != row[:3]:
                yield from on_slice(part.taken())
            part.add(row[:8])
    if now is not None:
        if rows := part.taken():
            yield from on_slice(rows)
        yield from on_block(now)


PIECE = ["block", "doc_id", "row_key", "piece", "last", "train", "head", "text", "n"]


def _merge(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in found)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in found)])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _distinct(keys: np.ndarray, weight: np.ndarray):
    """(distinct keys, summed weights), once for each weight."""
    for w in np.unique(weight):
        u, c = np.unique(keys if weight[0] == w and (weight == w).all() else keys[weight == w], return_counts=True)
        yield u, c * int(w)


def _asked(pieces: DataFrame) -> DataFrame:
    """(block, key, n): distinct grams and words of a block, n of them in training rows."""
    def task(batches):
        found: list = []

        def on_slice(rows):
            data, offsets, heads, last = _arrays(rows)
            weight = np.array([r[7] if r[4] else 0 for r in rows], dtype=np.int64)
            code, bounds = grams(data, offsets, heads, last)
            found.extend(_distinct(code, np.repeat(weight, np.diff(bounds))))
            w = Words(data, offsets)
            found.extend(_distinct(word_keys(w), weight[w.text]))
            if sum(len(k) for k, _ in found[1:]) > MERGE:
                found[:] = [_merge(found)]
            return ()

        def on_block(block):
            keys, counts = _merge(found)
            found.clear()
            for i in range(0, len(keys), 1 << 16):
                k = keys[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block, np.int32)), pa.array(k), pa.array(counts[i:i + (1 << 16)])],
                                                 names=["block", "key", "n"])

        yield from _walk(batches, PIECE, on_slice, on_block)

    return pieces.repartition("block").sortWithinPartitions("block", "row_key", "piece").mapInArrow(task, "block int, key long, n long")


def trie_scores(counts: DataFrame) -> DataFrame:
    """(key, value): log10 probability of each gram's last symbol after the
    others, from ``counts`` (key, n) of all grams, n = 0 for those not in training."""
    def low(col, symbols: int):
        return F.col(col).bitwiseAND(F.lit((1 << BITS * symbols) - 1))

    levels = {ORDER: counts.where("n > 0").select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        levels[k] = written(levels[k + 1].groupBy(low("key", k + 1).alias("key")).agg(F.sum("n").alias("n")))
    ctx = F.shiftright("key", BITS)
    of = Window.partitionBy("ctx")
    seen = levels[ORDER].withColumn("ctx", ctx).select(
        "key", F.log10(F.col("n") / (F.sum("n").over(of) + F.count(F.lit(1)).over(of))).alias("value"))
    rest = counts.where("n = 0").select("key", F.lit(0.0).alias("logp"), F.lit(0).cast("long").alias("gone"),
                                        F.lit(0).cast("long").alias("kinds"), F.lit(False).alias("done"))
    for k in range(ORDER, -1, -1):
        rows = levels[k]
        if k:
            below = levels[k - 1].select(F.col("key").alias("suffix"), F.col("n").alias("n_below"))
            rows = rows.withColumn("suffix", low("key", k)).join(below, "suffix")
        else:
            rows = rows.withColumn("n_below", F.lit(0).cast("long"))
        nodes = rows.groupBy(ctx.alias("ctx")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("n_below").alias("shadow"),
            F.map_from_entries(F.collect_list(F.struct(low("key", 1).alias("s"), "n"))).alias("symbols"))  # SYMBOLS entries at most
        j = rest.withColumn("ctx", F.shiftright("key", BITS).bitwiseAND(F.lit((1 << BITS * k) - 1))).join(nodes, "ctx", "left")
        total, kinds = F.col("total") - F.col("gone"), F.col("distinct") - F.col("kinds")
        n = F.try_element_at("symbols", low("key", 1))
        here = ~F.col("done") & F.col("total").isNotNull()
        step = F.when(n.isNotNull(), F.log10(n / (total + kinds))).when(kinds > 0, F.log10(kinds / (total + kinds))).otherwise(0.0)
        rest = j.select(
            "key", F.when(here, F.col("logp") + step).otherwise(F.col("logp")).alias("logp"),
            F.when(here & n.isNull(), F.col("shadow")).otherwise(F.col("gone")).alias("gone"),
            F.when(here & n.isNull(), F.col("distinct")).otherwise(F.col("kinds")).alias("kinds"),
            (F.col("done") | (here & n.isNotNull())).alias("done"))
    rest = rest.select("key", F.when(F.col("done"), F.col("logp")).otherwise(
        F.col("logp") - F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1)))).alias("value"))
    return seen.unionByName(rest)


def _packed(values: DataFrame) -> DataFrame:
    """(block, keys, vals): rows of up to PACK values of (block, key, value)."""
    def pack(held):
        block, key, value = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(block, kind="stable")
        block, key, value = block[order], key[order], value[order]
        cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        lots = [(i, min(i + PACK, hi)) for lo, hi in zip(cut, np.append(cut[1:], len(block))) for i in range(lo, hi, PACK)]
        for i in range(0, len(lots), 256):
            part = lots[i:i + 256]
            yield pa.RecordBatch.from_arrays([pa.array([block[a] for a, _ in part], pa.int32()), pa.array([key[a:z].tobytes() for a, z in part], pa.binary()),
                                              pa.array([value[a:z].tobytes() for a, z in part], pa.binary())], names=["block", "keys", "vals"])

    def task(batches):
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
                n += b.num_rows
            if n > PACK_ROWS:
                yield from pack(held)
                held, n = [], 0
        if held:
            yield from pack(held)

    return values.mapInArrow(task, "block int, keys binary, vals binary")


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    out, order = np.zeros(len(wanted)), np.argsort(wanted)  # a search in order finds its way in the cache
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def _scored(pieces: DataFrame, packed: DataFrame, kind: str) -> DataFrame:
    def task(batches):
        some: list = []  # a block's values as they come
        model: list = []  # and sorted

        def on_row(keys, vals):
            some.append((np.frombuffer(keys, np.int64), np.frombuffer(vals, np.float64)))

        def on_slice(rows):
            if not model:
                keys, val = (np.concatenate(x) for x in zip(*some))
                some.clear()
                order = np.argsort(keys)
                model.extend((keys[order], val[order]))
            keys, val = model
            data, offsets, heads, last = _arrays(rows)
            code, bounds = grams(data, offsets, heads, last)
            upto = np.concatenate(([0.0], np.cumsum(_look_up(keys, val, code))))
            w = Words(data, offsets)
            c, n = _look_up(keys, val, word_keys(w)), len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], doc_type), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                pa.array([r[7] for r in rows], pa.int64()), pa.array(w.counts.astype(np.int64)),
                pa.array(np.bincount(w.text, weights=c > 0, minlength=n).astype(np.int64)),
                pa.array(np.bincount(w.text, weights=np.log10(c + 1), minlength=n)), pa.array(upto[bounds[1:]] - upto[bounds[:-1]])],
                names=["doc_id", "row_key", "piece", "copies", "words", "known", "logs", "score"])

        def on_block(block):
            model.clear()
            some.clear()
            return ()

        doc_type = None
        for first in batches:
            doc_type = first.schema.field("doc_id").type
            yield from _walk(itertools.chain([first], batches), [*PIECE, "keys", "vals"], on_slice, on_block, on_row)

    # values (kind 0) before pieces
    both = packed.withColumn("kind", F.lit(0)).unionByName(pieces.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "kind", "row_key", "piece").mapInArrow(
        task, f"doc_id {kind}, row_key long, piece int, copies long, words long, known long, logs double, score double")


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", block_bytes: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens,
    base_score, score. ``held_out``: which rows not to learn from."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), (~held_out).alias("train"))
    kind = src.schema["doc_id"].dataType.simpleString()
    total, ends = src.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    ends = ends or 0
    pieces = _pieces(src, max(1, math.ceil((total or 0) / (block_bytes or BLOCK_BYTES))))
    asked = written(_asked(pieces))
    counts = written(asked.groupBy("key").agg(F.sum("n").alias("n")))
    words = counts.where("key < 0")
    n, v = words.where("n > 0").agg(F.sum("n"), F.count(F.lit(1))).first()
    n, v = (n or 0) + ends, v + (ends > 0)
    model = trie_scores(counts.where("key >= 0")).unionByName(words.select("key", F.col("n").cast("double").alias("value")))
    values = attach(asked.select("block", "key"), model, "key").select("block", "key", "value")
    scored = _scored(pieces, written(_packed(values)), kind)
    # rows with equal id and text have equal pieces; how many there are is in each
    rows = scored.groupBy("doc_id", "row_key").agg(F.max("copies").alias("copies"), *[F.sum(c).alias(c) for c in ("words", "known", "logs", "score")])
    step = 1 << 12  # equal rows are counted out in two steps, so that no array is long
    lots = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / step))))
    left = F.least(F.lit(step), F.col("copies") - F.col("lot") * step).cast("int")
    return lots.select("doc_id", (F.col("words") + 1).alias("n_tokens"), (F.col("known") + int(ends > 0)).alias("n_known"),
                       F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("logs") + math.log10(ends + 1) - (F.col("words") + 1) * math.log10(n + v + 1)).alias("base_score"),
                       "score", F.explode(F.sequence(F.lit(1), left)).alias("copy")).drop("copy")
