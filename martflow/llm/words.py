"""Vectorised word kernel used inside Arrow tasks.

One pass of numpy over the UTF-8 bytes of a batch of whole texts: lower-case
A-Z, split at ``[\\x20\\x09-\\x0D]``, 64-bit word hashes and word n-gram
(shingle) hashes. Slices of at most ``SLICE`` bytes (or one text, if that is
longer) bound the working memory to a small multiple of the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All ASCII but letters and digits: words without punctuation.
NO_WORD = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_RUN = np.uint64(0xA24BAED4963EE407)
_pow: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that low and high bits are usable."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _pow.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", _INV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _pow[name] = np.cumprod(a, dtype=np.uint64)
    return _pow["up"][:n], _pow["down"][:n]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts of at most ``size`` bytes together, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of a slice of texts: byte bounds, owning text, 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
        n = len(data)
        self.n_texts = len(offsets) - 1
        self.bytes = LOWER[data]
        solid = np.empty(n + 2, dtype=bool)
        solid[0] = solid[-1] = False
        np.logical_not(between[data], out=solid[1:-1])
        first = solid[1:-1] & ~solid[:-2]
        last = solid[1:-1] & ~solid[2:]
        # A text's edge is a word edge too.
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] = solid[1:-1][cut]
        last[cut - 1] = solid[1:-1][cut - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.counts = np.bincount(self.text, minlength=self.n_texts)
        #: Words of text i are first[i]:first[i + 1].
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self) -> np.ndarray:
        """Order-sensitive 64-bit hash of each (lower-cased) word."""
        n = len(self.bytes)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _powers(n + 1)
        s = np.empty(n + 1, dtype=np.uint64)
        s[0] = 0
        np.cumsum(_TABLE[self.bytes] * up[:n], out=s[1:])
        h = (s[self.end] - s[self.start]) * down[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(running hash, first word's number) of every k words of one text."""
        h = self.hashes() if h is None else h
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = h[:n].copy()
        for j in range(1, k):
            out *= _RUN
            out += h[j:n + j]
        at = np.flatnonzero(self.text[:n] == self.text[k - 1:])
        return mix(out[at] + np.uint64(k)), at

    def shingles(self, k: int, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text) of every k-word shingle; a text of fewer words has its
        whole word sequence as its one shingle; no words, none."""
        h = self.hashes() if h is None else h
        out, at = self.grams(k, h)
        text = self.text[at]
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if len(short):
            first, size = self.first[short], self.counts[short]
            few = h[first].copy()
            for j in range(1, k):
                more = size > j
                few[more] = few[more] * _RUN + h[first[more] + j]
            out, text = np.concatenate((out, mix(few + size.astype(np.uint64)))), np.concatenate((text, short))
        return out, text


def unique_per_text(h: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, sorted by (text, hash), and the bounds."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[keep], text[keep]
    return h, np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_texts))))
