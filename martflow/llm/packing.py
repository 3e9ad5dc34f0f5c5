"""Sequence packing along a space-filling curve.

A document's words are hashed into a signed vector; a fixed random
projection brings it to few dimensions; the cell on a Hilbert curve through
them is its sort key. Documents are range-partitioned and sorted by (key, id,
text hash) - the id breaks ties, so copies with one key still spread over
partitions - and each task streams along its stretch of the curve: it
tokenizes every whole text once and cuts the stream of ids into sequences of
exactly ``length`` ids. Only the last sequence of a partition is shorter, so
padding is below one sequence per partition.

Where the ranges begin is taken from the keys of some documents (``PLACED``),
which only decides how even they are; all documents are keyed once and packed.

Defined results: a null or empty text is just the end id; repeated rows are
packed each for itself; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, raw, slices

WIDTH = 64
DIMS = 3
BITS = 16

#: Documents whose keys place the ranges, about; bytes of text of a range while
#: there are fewer than the session's shuffle partitions, and at most.
PLACED = 20_000
RANGE_BYTES, MOST_BYTES = 8 << 20, 64 << 20


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates
    (n x dims, ``bits`` bits each), by the transposed-axes construction."""
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] = x[i] ^ t if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x = [v ^ t for v in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> b) & 1)
    return key


def projection(width: int = WIDTH, dims: int = DIMS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).normal(size=(width, dims))


def vectors(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Signed hashed vectors of the words of each text, dampened by the square
    root and of unit length."""
    w = Words(data, offsets)
    h, n = w.hashes(), w.n_texts
    sign = np.where(h >> np.uint64(63) != 0, 1.0, -1.0)
    v = np.bincount(w.text * width + (h % np.uint64(width)).astype(np.int64), weights=sign, minlength=n * width).reshape(n, width)
    v = np.sign(v) * np.sqrt(np.abs(v))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    x = vectors(data, offsets) @ projection()
    top = (1 << BITS) - 1
    return hilbert_key(np.clip((x + 3) / 6 * top, 0, top).astype(np.int64), BITS)


def _keyed(batches):
    """(batch, key, crc, size) of the texts' batches (doc_id, text)."""
    for b in batches:
        data, offsets = raw(b.column(1))
        key = np.concatenate([np.zeros(0, np.int64), *(curve_keys(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets))])
        yield b, key, [zlib.crc32(data[a:z]) for a, z in zip(offsets[:-1], offsets[1:])], np.diff(offsets)


def _place(key: int, doc_id, crc: int) -> tuple:
    """What documents are ordered by, null ids first."""
    return key, doc_id is not None, doc_id, crc


def range_bounds(src: DataFrame, partitions: int | None = None) -> list[tuple]:
    """First places of all ranges but the first, from about ``PLACED`` rows of
    (doc_id, text): ranges of equal bytes, as many as ``partitions`` or as the
    bytes ask for."""
    def task(batches):
        for b, key, crc, size in _keyed(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(crc, pa.int64()), pa.array(key, pa.int64()), pa.array(size, pa.int64())],
                                             names=["doc_id", "crc", "key", "size"])

    share = min(1.0, PLACED / max(1, src.count()))
    kind = src.schema["doc_id"].dataType.simpleString()
    some = src.sample(share, seed=77) if share < 1 else src
    rows = sorted((*_place(r["key"], r["doc_id"], r["crc"]), r["size"] + 16)
                  for r in some.mapInArrow(task, f"doc_id {kind}, crc long, key long, size long").collect())  # PLACED narrow rows
    upto = np.cumsum([r[-1] for r in rows])
    total = upto[-1] / share if rows else 0
    shuffle = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or max(1, int(min(total // RANGE_BYTES, max(shuffle, total // MOST_BYTES))))
    at = np.searchsorted(upto, upto[-1] * np.arange(1, n) / n, side="right") if rows else []
    return [rows[i][:-1] for i in sorted(set(at))]


def _ranged(bounds: list[tuple]):
    def task(batches):
        for b, key, crc, _ in _keyed(batches):
            part = [bisect_right(bounds, _place(*place)) for place in zip(key.tolist(), b.column(0).to_pylist(), crc)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(crc, pa.int64()), b.column(1), pa.array(key, pa.int64()), pa.array(part, pa.int32())],
                                             names=["doc_id", "crc", "text", "key", "part"])
    return task


# -- tokenizing -----------------------------------------------------------------


def _byte_names() -> dict[str, int]:
    """Byte of each character by which byte-level vocabularies write bytes:
    visible Latin-1 characters stand for themselves, the others follow at 256."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts by a tokenizer file. Special tokens' strings in
    a text are ordinary text.

    A byte-level vocabulary whose ids are its merge ranks (checked on a probe
    that both encode) is run by ``tiktoken`` on the same file, which gives the
    same ids in a quarter of the time; any other by ``tokenizers`` itself.
    """

    PROBE = "It's  the\tfirst 1234 -- naïve Ünïcödé \u3000 日本 \U0001F600\n\n <|endoftext|> x"
    NEVER = "\x00<|packing|>\x00"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = self._ranked()

    def _ranked(self):
        import public_tokenizers
        import tiktoken
        names = _byte_names()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        if not all(c in names for t in vocab for c in t):
            return None
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(names[c] for c in t): i for t, i in vocab.items() if t not in special}
        if sorted(ranks.values()) != list(range(len(ranks))):
            return None
        # encode_to_numpy looks for special tokens' strings, so there is one; in a text it is ordinary text
        fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={self.NEVER: len(ranks)})
        same = fast.encode_to_numpy(self.PROBE, disallowed_special=()).tolist() == self.tokenizer.encode(self.PROBE, add_special_tokens=False).ids
        return fast if same else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [np.asarray(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = 1024,
         end_id: int = 0, with_ids: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if ``with_ids``.

    ``tokenizer`` is the path of a byte-level tokenizer file, the same on every
    executor. ``sequence_id`` is unique, not gapless: the partition's number
    times 2^32 and a count.
    """
    def cut(batches):
        encode = encoder(tokenizer).encode
        part = TaskContext.get().partitionId() << 32
        seq, used = 0, 0
        for b in batches:
            col = b.column(1).fill_null("")
            names = b.column(0).to_pylist()
            _, offsets = raw(col)
            for i, j in slices(offsets):
                rows = []
                for k, ids in zip(range(i, j), encode(col.slice(i, j - i).to_pylist())):
                    doc = np.append(ids, np.uint32(end_id)).astype("<u4")
                    at = 0
                    while at < len(doc):
                        n = min(length - used, len(doc) - at)
                        piece = doc[at:at + n]
                        rows.append((names[k], at, n, zlib.crc32(piece), len(doc), part + seq, used, piece))
                        at += n
                        used += n
                        if used == length:
                            seq, used = seq + 1, 0
                cols = list(zip(*rows))
                arrays = [pa.array(cols[0], b.schema.field(0).type), *(pa.array(c, pa.int64()) for c in cols[1:7])]
                if with_ids:
                    upto = np.concatenate(([0], np.cumsum(cols[2]))).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(cols[7]).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, names=fields)

    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    bounds = range_bounds(src, partitions)
    keyed = src.mapInArrow(_ranged(bounds), f"doc_id {kind}, crc long, text string, key long, part int")
    sorted_ = keyed.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("key", "doc_id", "crc")
    return sorted_.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, " + ", ".join(f"`{f}` {'array<int>' if f == 'ids' else 'long'}" for f in fields[1:]))


def digest(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` computed from the ``ids`` that were
    emitted, in their place."""
    def task(batches):
        for b in batches:
            ids = b.column("ids")
            flat, size = ids.flatten().to_numpy().astype("<u4"), np.asarray(ids.value_lengths())
            upto = np.concatenate(([0], np.cumsum(size)))
            crc = pa.array([zlib.crc32(flat[i:j]) for i, j in zip(upto[:-1], upto[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([crc if f == "ids_crc32" else b.column(f) for f in fields], names=fields)

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    fields = [f for f in kinds if f != "ids"]
    return pieces.mapInArrow(task, ", ".join(f"`{f}` {kinds[f]}" for f in fields))
