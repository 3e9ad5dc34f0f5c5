"""Modified Kneser-Ney word bigrams whose counts are asked for by blocks of texts.

The model (see ``quality``) needs a count for each distinct pair of neighbouring
words, and a text's probability needs that count for each pair that it holds. Sent
as a row per pair of a text, that is several times the texts. Here a task's texts
are dealt into blocks of about ``BLOCK_TOKENS`` words, and a block asks once for
each of its distinct pairs:

1. A block is a dictionary (word hashes) and its texts as numbers in it, packed.
2. It sends the sorted hashes of its distinct pairs, with their counts in its
   training texts, to shards by ranges of the hash. A shard sums them and answers
   each block in the order of its question: the pair's count over all blocks, and
   a mark in one of the blocks that trained on it.
3. The marked pairs are the model's distinct pairs. A block asks the shards in the
   same way for its words' continuation counts and context totals, which are sums
   over marked pairs.
4. A block's texts meet its answers and are scored.

Blocks and shards hold bounded numbers of words and pairs however large the
corpus is, nothing of the model is broadcast, and the driver gets counts of counts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written
from .words import Words, mix, raw, slices

#: Words (and ends) of a block, and of the texts whose pairs a shard holds on average.
BLOCK_TOKENS, SHARD_TOKENS = 1 << 20, 1 << 20
#: Bytes of texts that a task works on at a time.
TEXT_BYTES = 1 << 19
FINISH, BEGIN = 0, 1  # their numbers in each dictionary
MARKS = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], dtype=np.uint64)  # and their hashes
PAIR = np.uint64(0x9E3779B97F4A7C15)


def packed(x: np.ndarray) -> bytes:
    """Unsigned numbers by byte planes, compressed."""
    x = x.astype(np.uint64)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T)
    top = max((k + 1 for k in range(8) if planes[k].any()), default=1)
    return len(x).to_bytes(7, "little") + bytes([top]) + pa.compress(planes[:top].tobytes(), codec="zstd", asbytes=True)


def unpacked(b: bytes) -> np.ndarray:
    n, top = int.from_bytes(b[:7], "little"), b[7]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :top] = np.frombuffer(pa.decompress(b[8:], decompressed_size=n * top, codec="zstd", asbytes=True), np.uint8).reshape(top, n).T
    return out.view(np.uint64).ravel()


def blocks(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text_key, lang, text) as (block, row, doc_id, text_key,
    lang, n_tokens), a row each, and (block, words, stream, sizes), a row per block."""
    names = ["block", "row", "doc_id", "text_key", "lang", "n_tokens", "words", "stream", "sizes"]
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}

    def task(batches):
        block, hashes, sizes, tokens, row = TaskContext.get().partitionId() << 32, [], [], 0, 0
        nulls = None

        def whole():
            h = np.concatenate(hashes)
            found, at, n = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small numbers
            number = np.empty(len(found), dtype=np.uint64)
            number[order] = np.arange(2, len(found) + 2, dtype=np.uint64)
            words = np.concatenate((MARKS, found[order]))
            return [pa.array([block]), pa.nulls(1, pa.int32()), *[pa.nulls(1, k) for k in nulls], pa.nulls(1, pa.int64()),
                    pa.array([words.tobytes()]), pa.array([packed(number[at])]), pa.array([packed(np.concatenate(sizes))])]

        for b in batches:
            nulls = [b.schema.field(k).type for k in range(3)]
            data, offsets = raw(b.column(3))
            for i, j in slices(offsets, TEXT_BYTES):
                w = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if row and tokens + len(w.start) + j - i > BLOCK_TOKENS:
                    yield pa.RecordBatch.from_arrays(whole(), names=names)
                    block, tokens, row = block + 1, 0, 0
                    hashes.clear()
                    sizes.clear()
                hashes.append(w.hashes())
                sizes.append(w.counts)
                n = j - i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block, np.int64)), pa.array(np.arange(row, row + n, dtype=np.int32)), *[b.column(k).slice(i, n) for k in range(3)],
                     pa.array(w.counts.astype(np.int64) + 1), *[pa.nulls(n, pa.binary())] * 3], names=names)
                tokens, row = tokens + len(w.start) + n, row + n
        if row:
            yield pa.RecordBatch.from_arrays(whole(), names=names)

    return texts.select("doc_id", "text_key", "lang", "text").mapInArrow(
        task, f"block long, row int, doc_id {kinds['doc_id']}, text_key long, lang {kinds['lang']}, n_tokens long, words binary, stream binary, sizes binary")


class Block:
    """A block's dictionary, and its texts' words as pairs (word before, word)
    of its numbers; the end follows a text's last word."""

    def __init__(self, words: bytes, stream: bytes, sizes: bytes):
        self.words = np.frombuffer(words, np.uint64)
        self.sizes = unpacked(sizes).astype(np.int64) + 1
        end = np.cumsum(self.sizes)
        self.start = end - self.sizes
        after = np.zeros(end[-1], dtype=np.uint64)
        inner = np.ones(len(after), dtype=bool)
        inner[end - 1] = False
        after[inner] = unpacked(stream)
        before = np.empty_like(after)
        before[1:] = after[:-1]
        before[self.start] = BEGIN
        self.pairs = (before << np.uint64(31)) | after

    def ends(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (pairs >> np.uint64(31)).astype(np.int64), (pairs & np.uint64((1 << 31) - 1)).astype(np.int64)

    def hashes(self, pairs: np.ndarray) -> np.ndarray:
        a, b = self.ends(pairs)
        return mix(self.words[a] * PAIR + mix(self.words[b]))


def _first(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1])))


ASKED = ["shard", "block", "hashes", "counts"]
ASKED_KINDS = "shard int, block long, hashes binary, counts array<binary>"


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _ask(block: int, hashes: np.ndarray, counts: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """Rows of a block's question, one for each shard."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], [c[order] for c in counts]
    shard = _shard(hashes, shards)
    cut = [*_first(shard).tolist(), len(hashes)]
    rows = [(int(shard[i]), block, packed(np.diff(hashes[i:j], prepend=np.uint64(0))), [packed(c[i:j]) for c in counts])
            for i, j in zip(cut, cut[1:]) if i < j]
    types = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=ASKED)


def _ask_pairs(shards: int, turn: int):
    """Each block's distinct pairs and how often its training rows hold them."""
    def task(batches):
        for b in batches:
            for block, words, stream, sizes, rows in zip(*(b.column(k).to_pylist() for k in range(5))):
                x = Block(words, stream, sizes)
                train = np.zeros(len(x.sizes), dtype=np.uint64)
                train[np.array(rows or [], dtype=np.int64)] = 1
                held = np.sort((x.pairs << np.uint64(1)) | np.repeat(train, x.sizes))
                first = _first(held >> np.uint64(1))
                n = np.add.reduceat(held & np.uint64(1), first)
                h = x.hashes(held[first] >> np.uint64(1))
                now = _shard(h, shards) % np.uint64(PAIR_TURNS) == turn
                yield _ask(block, h[now], [n[now]], shards)
    return task


def _answers(marked: bool):
    """A shard: each question's sums over all blocks; if ``marked``, twice the sum
    and one more in one of the blocks that count the hash. ``of``: how many hashes
    have a (last) sum of 1, 2, 3, 4 and more, and the sums' total."""
    def task(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        hashes = [np.cumsum(unpacked(x), dtype=np.uint64) for x in t["hashes"].to_pylist()]
        counts = t["counts"].to_pylist()
        cut = np.cumsum([0, *map(len, hashes)])
        h = np.concatenate(hashes)
        order = np.argsort(h)
        first = _first(h[order])
        size = np.diff(np.append(first, len(h)))
        sums = []
        for k in range(len(counts[0])):
            n = np.concatenate([unpacked(c[k]) for c in counts])[order]
            total = np.add.reduceat(n, first)
            each = np.repeat(total, size)
            if marked:
                seen = n > 0
                upto = np.cumsum(seen)
                each = each * np.uint64(2) + (seen & (upto - np.repeat(upto[first] - seen[first], size) == 1))
            out = np.empty_like(each)
            out[order] = each
            sums.append([packed(out[i:j]) for i, j in zip(cut, cut[1:])])
        of = [*np.bincount(np.minimum(total, 5).astype(np.int64), minlength=6)[1:].tolist(), int(total.sum())]
        return pa.table({"block": t["block"], "shard": t["shard"], "sums": pa.array(list(zip(*sums)), pa.list_(pa.binary())),
                         "of": pa.array([of, *[None] * (len(hashes) - 1)], pa.list_(pa.int64()))})
    return task


ANSWERS = "block long, shard int, sums array<binary>, of array<long>"


def _sums(t: pa.Table) -> list[np.ndarray]:
    """A block's answers in the order of its hashes."""
    shard, sums = t["shard"].to_pylist(), t["sums"].to_pylist()
    order = np.argsort(shard, kind="stable")
    return [np.concatenate([unpacked(sums[i][k]) for i in order]) for k in range(len(sums[0]))]


def _block(t: pa.Table) -> Block:
    return Block(*(t[c][0].as_py() for c in ("words", "stream", "sizes")))


def _ask_words(shards: int, turn: int):
    """A block's words, with the sums of the pairs marked in it: as a context the
    total and the pairs of count 1, 2 and more, as a follower the pairs."""
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _block(left)
        pairs = np.unique(x.pairs)
        by_hash = np.argsort(x.hashes(pairs))
        sums, = _sums(right)
        mine = (sums & np.uint64(1)).astype(bool)
        a, b = x.ends(pairs[by_hash][mine])
        c = (sums[mine] >> np.uint64(1)).astype(np.int64)
        size = len(x.words)
        cols = [np.bincount(a, weights=c, minlength=size), *[np.bincount(a[np.minimum(c, 3) == k], minlength=size) for k in (1, 2, 3)],
                np.bincount(b, minlength=size)]
        now = _shard(x.words, shards) % np.uint64(WORD_TURNS) == turn
        return pa.Table.from_batches([_ask(left["block"][0].as_py(), x.words[now], [col[now].astype(np.uint64) for col in cols], shards)])
    return task


def _scored(two: list[float], one: list[float], total: int, unknown: float):
    """A block's texts: the sums of their pairs' log10 probabilities."""
    def discount(c, d):
        return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _block(left)
        of_words = pa.compute.equal(right["kind"], 1)
        words = _sums(right.filter(of_words))
        sums, = _sums(right.filter(pa.compute.invert(of_words)))
        order = np.argsort(x.pairs)
        first = _first(x.pairs[order])
        pairs = x.pairs[order[first]]
        by_hash = np.argsort(x.hashes(pairs))
        c = np.empty(len(pairs))
        c[by_hash] = sums >> np.uint64(1)
        n, n1, n2, n3, follows = np.empty((5, len(x.words)))
        place = np.argsort(x.words)
        for to, col in zip((n, n1, n2, n3, follows), words):
            to[place] = col
        rest = np.where(n > 0, (n1 * two[0] + n2 * two[1] + n3 * two[2]) / np.maximum(n, 1), 1.0)
        p = (follows - discount(follows, one)) / total + unknown
        a, b = x.ends(pairs)
        log = np.empty(len(x.pairs))
        log[order] = np.repeat(np.log10((c - discount(c, two)) / np.maximum(n[a], 1) + rest[a] * p[b]), np.diff(np.append(first, len(x.pairs))))
        return pa.table({"block": np.full(len(x.sizes), left["block"][0].as_py(), np.int64), "row": np.arange(len(x.sizes), dtype=np.int32),
                         "v": np.add.reduceat(log, x.start)})
    return task


#: A step's shuffle is on disk beside the blocks, so pairs and words are asked for, and blocks answered, in so many turns.
PAIR_TURNS, WORD_TURNS, BLOCK_TURNS = 4, 3, 6


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _in_turns(turns: int, step) -> DataFrame:
    return _union([written(step(k)) for k in range(turns)])


def _turn(df: DataFrame, k: int):
    return df.where(F.pmod(F.xxhash64("block"), F.lit(BLOCK_TURNS)) == k).groupBy("block")


def log_probabilities(texts: DataFrame, trained, discounts) -> DataFrame:
    """``texts`` (doc_id, text_key, lang, text; words already in the case that
    counts) with n_tokens and ``v``, the log10 probability of the text under the
    model of its training rows (0 if there are none). ``trained(rows)`` picks
    those from (block, row, doc_id, text_key); ``discounts`` gives the three
    discounts from a list of counts of counts, from 0 to 4."""
    both = written(blocks(texts))
    rows = both.where("row is not null").select("block", "row", "doc_id", "text_key", "lang", "n_tokens")
    whole = both.where("row is null").select("block", "words", "stream", "sizes")
    train = written(trained(rows).groupBy("block").agg(F.collect_list("row").alias("rows")))
    shards = max(1, -(-(rows.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD_TOKENS))
    asking = whole.join(train, "block", "left").select("block", "words", "stream", "sizes", "rows")
    pairs = _in_turns(PAIR_TURNS, lambda k: asking.mapInArrow(_ask_pairs(shards, k), ASKED_KINDS)
                      .groupBy("shard").applyInArrow(_answers(True), ANSWERS))

    def of_words(turn: int) -> DataFrame:
        asked = _in_turns(BLOCK_TURNS, lambda k: _turn(whole, k).cogroup(_turn(pairs, k)).applyInArrow(_ask_words(shards, turn), ASKED_KINDS))
        answered = written(asked.groupBy("shard").applyInArrow(_answers(False), ANSWERS))
        dropped(asked)
        return answered

    words = _union([of_words(k) for k in range(WORD_TURNS)])
    of = [n or 0 for n in words.where("of is not null").agg(*[F.sum(F.col("of")[k]) for k in range(6)]).first()]
    total = of[5]
    if not total:
        return rows.withColumn("v", F.lit(0.0)).drop("block", "row")
    of_pairs = pairs.where("of is not null").agg(*[F.sum(F.col("of")[k]) for k in range(4)]).first()
    two, one = discounts([0, *of_pairs]), discounts([0, *of[:4]])
    unknown = (one[0] * of[0] + one[1] * of[1] + one[2] * sum(of[2:5])) / total / (sum(of[:5]) + 1)
    answers = pairs.drop("of").withColumn("kind", F.lit(0)).unionByName(words.drop("of").withColumn("kind", F.lit(1)))
    scores = _in_turns(BLOCK_TURNS, lambda k: _turn(whole, k).cogroup(_turn(answers, k))
                       .applyInArrow(_scored(two, one, total, unknown), "block long, row int, v double"))
    return rows.join(scores, ["block", "row"]).drop("block", "row")
