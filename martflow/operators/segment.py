"""Dictionary segmentation in its coarsest mode.

A run of ideographs (or of letters written without spaces) has no word marks; a
dictionary says which pieces of it are words. All dictionary words in a run
form a lattice over its positions. The coarsest cut is the path through it with

1. the fewest code points that belong to no word (each is a piece of its own),
2. then the fewest pieces,
3. then the largest sum of squared piece lengths (long words rather than even ones),
4. then the longest first piece, and so on to the right,

found by dynamic programming from the right end. A greedy longest match would
miss cuts whose first word is short.

Only distinct runs are segmented; how often they occur is multiplied in after
it. The dictionary is a table. Up to ``TRIE_BYTES`` of words (counted first) it
is broadcast as a trie, and a run's lattice is read off it letter by letter;
beyond, the lattice is a join of the runs' substrings with the dictionary, so
that neither the driver nor a task holds the dictionary. Both give the same
cuts; their choice depends on the dictionary only, never on the texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import tokens

#: Dictionary words, UTF-8 bytes together, that are broadcast at most.
TRIE_BYTES = 4 << 20


def _trie(words: list[str]) -> dict[str, bool]:
    """Every prefix of a word -> whether it is a word."""
    trie: dict[str, bool] = {}
    for w in words:
        for i in range(1, len(w)):
            trie.setdefault(w[:i], False)
        trie[w] = True
    return trie


def _edges(run: str, trie: dict[str, bool]) -> list[list[int]]:
    """Lengths of the words that start at each position."""
    out = []
    for i in range(len(run)):
        found = []
        for j in range(i + 1, len(run) + 1):
            known = trie.get(run[i:j])
            if known is None:
                break
            if known:
                found.append(j - i)
        out.append(found)
    return out


def _cut(run: str, edges: list[list[int]]) -> list[str]:
    """The coarsest path through the lattice."""
    n = len(run)
    best = [(0, 0, 0, 0)] * (n + 1)  # loose code points, pieces, minus squares, minus first length
    for i in range(n - 1, -1, -1):
        loose, pieces, squares, _ = best[i + 1]
        top = (loose if 1 in edges[i] else loose + 1, pieces + 1, squares - 1, -1)
        for size in edges[i]:
            loose, pieces, squares, _ = best[i + size]
            way = (loose, pieces + 1, squares - size * size, -size)
            if way < top:
                top = way
        best[i] = top
    out, i = [], 0
    while i < n:
        out.append(run[i:i - best[i][3]])
        i -= best[i][3]
    return out


def _batch(b: pa.RecordBatch, pieces: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pieces, pa.list_(pa.string()))], names=["run", "n", "pieces"])


OUT = "run string, n long, pieces array<string>"


def _with_trie(runs: DataFrame, words: list[str]) -> DataFrame:
    held = runs.sparkSession.sparkContext.broadcast(words)

    def task(batches):
        trie = _trie(held.value)
        for b in batches:
            yield _batch(b, [_cut(x, _edges(x, trie)) for x in b.column(0).to_pylist()])

    return runs.mapInArrow(task, OUT)


def _with_join(runs: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    def task(batches):
        for b in batches:
            pieces = []
            for x, found in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                edges: list[list[int]] = [[] for _ in x]
                for e in found or []:
                    edges[e["at"]].append(e["size"])
                pieces.append(_cut(x, edges))
            yield _batch(b, pieces)

    at = runs.select("run", F.explode(F.sequence(F.lit(0), F.length("run") - 1)).alias("at"))
    most = F.least(F.length("run") - F.col("at"), F.lit(longest))
    parts = at.select("run", "at", F.explode(F.sequence(F.lit(1), most)).alias("size")) \
        .withColumn("word", F.expr("substr(run, at + 1, size)"))
    lattice = parts.join(words, "word").groupBy("run").agg(F.collect_list(F.struct("at", "size")).alias("found"))
    return runs.join(lattice, "run", "left").select("run", "n", "found").mapInArrow(task, OUT)


def segment_runs(runs: DataFrame, dictionary: DataFrame, run: str = "run", word: str = "word", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(run, n, pieces): every distinct non-empty run, how often it occurs, and
    its coarsest cut. Words of ``dictionary`` are compared as they are; null and
    empty ones don't count."""
    distinct = runs.select(F.col(run).alias("run")).where(F.length("run") > 0).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    words = dictionary.select(F.col(word).alias("word")).where(F.length("word") > 0).distinct()
    size, longest = words.agg(F.sum(F.octet_length("word")), F.max(F.length("word"))).first()
    if not size:
        return distinct.select("run", "n", F.regexp_extract_all("run", F.lit("(?s)."), 0).alias("pieces"))
    if size <= trie_bytes:
        return _with_trie(distinct, [r["word"] for r in words.collect()])
    return _with_join(distinct, words, longest)


def segment_counts(texts: DataFrame, text: str, dictionary: DataFrame, runs: Column | None = None, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(keyword, keyword_count): pieces of all runs of the whole texts. ``runs``:
    the array of runs of a text (its tokens, if not given)."""
    found = texts.select(F.explode(tokens(text) if runs is None else runs).alias("run"))
    return segment_runs(found, dictionary, trie_bytes=trie_bytes).select("n", F.explode("pieces").alias("keyword")) \
        .groupBy("keyword").agg(F.sum("n").cast("bigint").alias("keyword_count"))


def frequent_words(texts: DataFrame, text: str, shortest: int, longest: int, least: Column) -> DataFrame:
    """A dictionary from the texts themselves: tokens of ``shortest`` to
    ``longest`` code points that occur ``least`` times or more."""
    return texts.select(F.explode(tokens(text)).alias("word")).where(F.length("word").between(shortest, longest)) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("word")
