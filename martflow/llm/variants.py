"""Spelling variants: near words by permuterm rotations.

Words are letter runs of whole texts, counted over all documents. Two words are
near if one inserted, deleted or replaced code point parts them. A word w is
marked with a terminator, and all rotations of ``w$`` are sorted. In a rotation
the code point at the edited place is the last one, so

* words that differ by a replacement there share the rotation but its last
  code point: a prefix range that skips the edited character, and
* a word without that code point has the shared prefix itself as a rotation.

Each prefix range is thus one sorted group, all of whose members are near each
other, and it holds one word per letter and one without at most: its size is
bounded by the alphabet, whatever the corpus. A scan over the sorted rotations
keeps of each group its size and its two most frequent members; that is all a
member needs to learn how many partners it has there and which is the most
frequent, so pairs are never written. A pair that differs by a replacement meets
in one range. One that differs by an indel inside a run of equal letters meets
in several; it counts where the edited letter is the run's first.

Rotations are range-partitioned by prefix, so a range never crosses partitions
and the work per task follows the sort's sample, not a hash of hot keys.

A word's form is its most frequent near word, if that is ``ratio`` times as
frequent; its root is found along the forms by pointer doubling. Along a chain
counts grow ``ratio``-fold, so the number of joins is the logarithm of a logarithm
of the largest count.

Defined results: a null text has no words; a null id is written as the empty
string; a row that occurs twice counts twice; ties in n go to the smaller word
in code-point order; an empty table, or one without frequent words, gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .words import raw

# Fixed value: a letter, in UTF-8 and lower-cased: a-z, U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_PIECE = 1 << 20
_FLUSH = 200_000
MARK = "$"


def _cut(text: bytes):
    """Pieces of about a MB, cut where no letter run goes on."""
    lo = 0
    while len(text) - lo > _PIECE:
        hi = lo + _PIECE
        # a letter's bytes are a-z, C3 or 80-BF; a cut in front of any other byte parts no run
        while hi < len(text) and (97 <= text[hi] <= 122 or text[hi] >= 0x80):
            hi += 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def damaged(run: str, h: int, every: int) -> str:
    """The run less one code point, for one in ``every`` hashes."""
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, every: int = 199) -> DataFrame:
    """(word, n): words of ``least_length`` code points or more, after one in
    ``every`` (document, run) lost a code point. Counts are summed per task
    before they are shuffled."""
    def task(batches):
        words: Counter = Counter()

        def out():
            keys = [w.decode() for w in words]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            data, offsets = raw(b.column(1))
            for k, doc in enumerate(b.column(0).to_pylist()):
                whole = data[offsets[k]:offsets[k + 1]].tobytes().lower()
                start = zlib.crc32(f"{doc or ''}:".encode())
                here: Counter = Counter()
                for part in _cut(whole):
                    here.update(_RUN.findall(part))
                for run, n in here.items():
                    h = zlib.crc32(run, start)
                    if h % every == 0:
                        run = damaged(run.decode(), h, every).encode()
                    if len(run) >= least_length and (run.isascii() or len(run.decode()) >= least_length):
                        words[run] += n
                if len(words) > _FLUSH:
                    yield out()
                    words.clear()
        if words:
            yield out()

    src = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(range, edited, n): every rotation of every marked word, once as a whole
    (``edited`` empty: the word lacks a code point there) and once less its last
    code point (``edited``). The word is ``tail of range`` + edited + ``head``."""
    at = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")
    rot = words.select("word", "n", at).select(
        "n", "at", F.concat(F.expr("substr(word, at + 1)"), F.lit(MARK), F.expr("substr(word, 1, at)")).alias("rot"))
    whole = F.struct(F.col("rot").alias("range"), F.lit("").alias("edited"))
    less = F.struct(F.expr("substr(rot, 1, length(rot) - 1)").alias("range"), F.expr("right(rot, 1)").alias("edited"))
    return rot.select("n", F.explode(F.when(F.col("at") > 0, F.array(whole, less)).otherwise(F.array(whole))).alias("r")) \
        .select("r.range", "r.edited", "n")


def _scan(batches):
    """Walks the sorted ranges: (word, near, best_n, best) of every member of a
    range of two or more. A range holds a member per letter and one without."""
    def members(range_, group, out):
        if len(group) < 2:
            return
        tail, _, head = range_.partition(MARK)
        named = [(n, head + e + tail, e) for e, n in group]
        lead = sorted(named, key=lambda m: (-m[0], m[1]))[:2]
        letters = sum(e != "" for _, _, e in named)
        short = len(named) > letters
        before = head[-1:]  # an indel counts if its letter starts a run
        for n, word, e in named:
            if e:
                near = letters - 1 + (short and e != before)
            else:
                near = sum(1 for _, _, x in named if x and x != before)
            best = lead[0] if lead[0][1] != word else lead[1]
            out.append((word, int(near), best[0], best[1]))

    now, group, out = None, [], []
    for b in batches:
        for range_, edited, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            if range_ != now:
                if now is not None:
                    members(now, group, out)
                now, group = range_, []
            group.append((edited, n))
        if out:
            yield _batch(out)
            out = []
    if now is not None:
        members(now, group, out)
    if out:
        yield _batch(out)


def _batch(rows: list) -> pa.RecordBatch:
    word, near, best_n, best = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
                                      names=["word", "near", "best_n", "best"])


def _better(n: str, word: str) -> Column:
    """Orders by n, then by the smaller word: UTF-8 bytes, which Spark compares
    as unsigned ones, order like code points."""
    return F.struct((-F.col(n)).alias("n"), F.col(word).alias("word"))


def near_words(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n) of every row of ``words`` (word, n)."""
    found = rotations(words).repartitionByRange("range").sortWithinPartitions("range") \
        .mapInArrow(_scan, "word string, near long, best_n long, best string")
    both = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best")) \
        .unionByName(found.select("word", F.lit(None).cast("long").alias("n"), "near", "best_n", "best"))
    one = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"),
                                   F.min(F.when(F.col("best").isNotNull(), _better("best_n", "best"))).alias("b"))
    enough = -F.col("b.n") >= ratio * F.col("n")
    return one.select("word", "n", "n_near", F.when(enough, F.col("b.word")).alias("form"), F.when(enough, -F.col("b.n")).alias("form_n"))


def with_roots(near: DataFrame, ratio: int = 5) -> DataFrame:
    """Adds ``root``: the last word along the forms, the word itself without a form."""
    most, least = near.agg(F.max("n"), F.min("n")).first()
    if most is None:
        return near.withColumn("root", F.col("word"))
    steps = 1 + int(math.log(most / least, ratio) + 1e-9)  # forms in a chain at most
    links = near.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        up = links.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        links = links.join(up, F.col("root") == F.col("__word"), "left") \
            .select("word", F.coalesce("__root", "root").alias("root"))
        links = written(links)
    return near.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5,
                      every: int = 199, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``least_length``
    code points and ``least_count`` occurrences."""
    words = written(counted(docs, doc_id, text, least_length, every).where(F.col("n") >= least_count))
    near = written(near_words(words, ratio))
    return with_roots(near, ratio).select("word", "form", "root", "n", "n_near", "form_n")
