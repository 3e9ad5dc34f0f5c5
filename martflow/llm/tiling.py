"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are sequences of lower-cased words (ASCII punctuation
and white space separate them). A running Karp-Rabin hash over the words gives
the ``seed`` words at every position. Documents and items that share a seed are
joined on it; the pair's seed matches, as (document position, item position),
make up all its common passages of at least ``seed`` words, since such a
passage is a run of matches on one diagonal. Greedy tiling repeatedly marks the
longest passage whose words are unmarked on both sides. A document whose tiles
cover at least ``least`` of an item's words is contaminated by it, whatever the
order in which it holds the item's passages.

In a stretch of one repeated word all common passages of a length look alike, and
tiling takes the first that is free. An item's tiles mark as many words of the
document as of the item, so with m words in an item they can't bar more than
m + m / seed * m places; of longer stretches only that many positions at either
end leave the scan, whatever the stretch's length, and the tiles are the same.

The scan of whole documents is one narrow pass. Only positions whose seed is in
a Bloom filter of all the benchmark's seeds leave it; the filter's size is a
parameter, so a benchmark of any size only lets more positions pass, and the
join decides exactly (64-bit hashes).

An item of fewer than ``seed`` words has no seed. Its whole text is its one
passage instead: it is searched for like a seed, and of a document only the first
place that holds it leaves the scan, since that tile covers the item.

Defined results: null and empty texts or items match nothing; repeated rows (equal id and text) are one document;
rows with one id and several texts are reported for each text; a null id is
reported as null; empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, may_hold
from .words import NO_WORD, Words, raw, slices

SEED = 5
LEAST = 0.5
FILTER_BITS = 1 << 22


def _edges(h: np.ndarray, at: np.ndarray, text: np.ndarray, keep: int) -> np.ndarray:
    """Which seeds to keep where one word is repeated on and on, so that a text
    has the same seed at each position of a stretch: the first and the last
    ``keep`` of the stretch."""
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
    start = np.flatnonzero(fresh)
    size = np.diff(np.append(start, len(h)))
    rank = np.arange(len(h)) - np.repeat(start, size)
    return (rank < keep) | (rank >= np.repeat(size, size) - keep)


def _first_of_text(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where each (text, seed) comes first, in ascending order."""
    order = np.lexsort((h, text))  # stable
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    return np.sort(order[fresh])


def _seeds(df: DataFrame, seed: int, bloom: np.ndarray | None, keep: int = 0, short: Sequence[int] = ()) -> DataFrame:
    """(id, key, words, pos, seed) of every seed of each text, and the whole text
    of those of fewer words; with ``bloom`` only of seeds that may be in it, of a
    repeated word's only those at the edges (see :func:`_edges`), and the first
    places of passages of ``short`` lengths."""
    held = None if bloom is None else df.sparkSession.sparkContext.broadcast(bloom)  # FILTER_BITS / 8 bytes

    def found(w: Words):
        words = w.hashes()
        h, at = w.grams(seed, words)
        if held is None:
            yield h, at
            for k in range(1, seed):
                h, at = w.grams(k, words)
                whole = w.counts[w.text[at]] == k
                yield h[whole], at[whole]
            return
        hit = may_hold(held.value, h)
        h, at = h[hit], at[hit]
        if len(h):
            edge = _edges(h, at, w.text[at], keep)
            yield h[edge], at[edge]
        for k in short:
            h, at = w.grams(k, words)
            hit = may_hold(held.value, h)
            h, at = h[hit], at[hit]
            first = _first_of_text(h, w.text[at])
            yield h[first], at[first]

    def task(batches):
        for b in batches:
            data, offsets = raw(b.column(2))
            for i, j in slices(offsets):
                w = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], NO_WORD)
                for h, at in found(w):
                    if not len(h):
                        continue
                    text = w.text[at]
                    rows = pa.array(text + i)
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(rows), b.column(1).take(rows), pa.array(w.counts[text]),
                        pa.array(at - w.first[text]), pa.array(h.view(np.int64))], names=["id", "key", "words", "pos", "seed"])

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "key", "text").mapInArrow(task, f"id {kind}, key long, words long, pos long, seed long")


def tile(doc_pos: np.ndarray, item_pos: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from all seed matches: tiles (document position, item
    position, length), longest first; ties by document, then item position."""
    order = np.lexsort((doc_pos, doc_pos - item_pos))
    d, t = doc_pos[order], item_pos[order]
    fresh = np.ones(len(d), dtype=bool)
    fresh[1:] = (d[1:] - t[1:] != d[:-1] - t[:-1]) | (d[1:] > d[:-1] + 1)
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], len(d)) - 1
    heap = [(-int(d[e] - d[s] + seed), int(d[s]), int(t[s])) for s, e in zip(start, end)]
    heapq.heapify(heap)
    in_doc, in_item, tiles = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + i not in in_doc and b + i not in in_item for i in range(-n)]
        if all(free):
            in_doc.update(range(a, a - n))
            in_item.update(range(b, b - n))
            tiles.append((a, b, -n))
            continue
        i = 0
        while i < len(free):  # what others left of it may still be long enough
            if not free[i]:
                i += 1
                continue
            e = i
            while e < len(free) and free[e]:
                e += 1
            if e - i >= seed:
                heapq.heappush(heap, (i - e, a + i, b + i))
            i = e
    return tiles


def contaminated(docs: DataFrame, items: DataFrame, seed: int = SEED, least: float = LEAST, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """One row per document text and item it contains: doc_id, text_key
    (xxhash64 of the text), item_id, coverage, tiles array<struct<doc_start,
    item_start, length>> in words."""
    def keyed(df, i, t):
        return df.select(F.col(i).alias("id"), F.xxhash64(t).alias("key"), F.col(t).cast("string").alias("text"))

    bench = _seeds(keyed(items, item_id, item_text), seed, None)
    bloom = bloom_filter(bench, "seed", bits)
    most, short = bench.agg(F.max("words"), F.collect_set(F.when(F.col("words") < seed, F.col("words")))).first()
    most = most or 0
    hits = _seeds(keyed(docs, doc_id, text), seed, bloom, most + most // seed * most, sorted(short)) \
        .select(F.col("id").alias("doc_id"), F.col("key").alias("text_key"), F.col("pos").alias("doc_pos"), "seed")
    pairs = hits.join(bench.select(F.col("id").alias("item_id"), F.col("key").alias("item_key"), "words",
                                   F.col("pos").alias("item_pos"), "seed"), "seed")

    def task(t: pa.Table) -> pa.Table:
        words = t.column("words")[0].as_py()
        at = np.unique(np.stack([t.column("doc_pos").to_numpy(), t.column("item_pos").to_numpy()]), axis=1)
        tiles = tile(at[0], at[1], min(seed, words))
        covered = sum(n for _, _, n in tiles)
        if covered < least * words:
            return out.empty_table()
        return pa.Table.from_arrays([
            t.column("doc_id").slice(0, 1), t.column("text_key").slice(0, 1), t.column("item_id").slice(0, 1), pa.array([covered / words]),
            pa.array([[{"doc_start": a, "item_start": b, "length": n} for a, b, n in tiles]], out.field(4).type)], schema=out)

    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")}
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    out = pa.schema([("doc_id", arrow[kinds["doc_id"]]), ("text_key", pa.int64()), ("item_id", arrow[kinds["item_id"]]), ("coverage", pa.float64()),
                     ("tiles", pa.list_(pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])))])
    return pairs.groupBy("doc_id", "text_key", "item_id", "item_key").applyInArrow(
        task, f"doc_id {kinds['doc_id']}, text_key long, item_id {kinds['item_id']}, coverage double, "
              "tiles array<struct<doc_start: long, item_start: long, length: long>>")


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones; all columns and other rows kept."""
    bad = contaminated(docs, items, doc_id=doc_id, text=text, **options) \
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__key")), "left_anti")
