"""Near-duplicate documents by min-max hashing of word shingles.

Each document's set of distinct word shingles (64-bit hashes) gets a signature
that keeps both the minimum and the maximum under every permutation, so 80
permutations give 160 values of lower variance than 160 minima at half the
hash evaluations. Five values make a band, 32 bands a signature: documents of
similarity 0.8 share a band with probability above 0.99999.

1. One pass over whole texts gives id, set size, class (hash of the set: equal
   sets are one class from here on) and 32 band keys, written once.
2. Classes that share a band key are linked to the smallest class of that key;
   connected components of those unverified links are families. No other pair
   of different classes can be a candidate.
3. Families are verified on full sets, recomputed from one
   text per class, named by its id and hash: a family of bounded size is one task group, where an
   inverted index over its shingles counts intersections. Larger families are
   dealt into random parts of bounded size, several times over; documents that
   after that aren't in their family's largest component are compared, block
   by block, with all of the family. Only links that join two components are
   emitted, never all pairs. What two members of a family link is found
   whatever the family's size.
4. Components of verified links; the smallest id names one.

Defined results: a text without words (null, empty, white space) has size 0 and
links with nothing; fewer words than the shingle size make the whole sequence
the one shingle; rows with equal sets are linked; repeated rows each give a
row; a null id never names a component unless all ids of the component are
null (then component_id and kept are null), but its text links like others; an
empty table gives an empty table; other columns are ignored. An id may have
several texts: what is to be kept is a row, so :func:`grouped` also tells which
rows represent their component, by id and text hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, may_hold, written
from .graph import attach, chunked, components, sized
from .words import Words, mix, raw, slices, unique_per_text

PERMUTATIONS = 80
PER_BAND = 5
BANDS = 2 * PERMUTATIONS // PER_BAND
#: Bounds of a verifying task group: documents, shingles.
GROUP_ROWS = 512
GROUP_SHINGLES = 1_000_000
#: Size of the filter that keeps texts of no family from being shuffled. Too
#: small a filter only lets more of them pass.
FILTER_BITS = 1 << 23


def _factors() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(4051))
    return rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)


def min_max(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Signatures (texts x 2 * PERMUTATIONS) of non-empty sets: minimum and
    maximum of each permutation side by side."""
    first = bounds[:-1]
    out = np.empty((len(first), 2 * PERMUTATIONS), dtype=np.uint64)
    for p, a in enumerate(_factors()):
        v = sets * a
        out[:, 2 * p] = np.minimum.reduceat(v, first)
        out[:, 2 * p + 1] = np.maximum.reduceat(v, first)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    s = signatures.reshape(len(signatures), BANDS, PER_BAND)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2]).copy()
    for r in range(PER_BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
    return key


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    w = Words(data, offsets)
    h, text = w.shingles(k)
    return unique_per_text(h, text, w.n_texts)


def set_class(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of each set (0 for the empty one)."""
    n = np.diff(bounds)
    full = n > 0
    out = np.zeros(len(n), dtype=np.uint64)
    if full.any():
        first = bounds[:-1][full]
        out[full] = mix(np.add.reduceat(sets, first) ^ mix(np.bitwise_xor.reduceat(mix(sets), first)) + n[full].astype(np.uint64))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def signatures(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class, bands array<long>)."""
    def task(batches):
        for b in batches:
            data, offsets = raw(b.column(1))
            ns, cs, bands, sizes = [], [], [], []
            for i, j in slices(offsets):
                sets, bounds = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                n = np.diff(bounds)
                full = n > 0
                tight = np.concatenate(([0], np.cumsum(n[full])))
                keys = band_keys(min_max(sets, tight)) if full.any() else np.zeros((0, BANDS), np.uint64)
                ns.append(n)
                cs.append(set_class(sets, bounds))
                bands.append(keys.ravel())
                sizes.append(np.where(full, BANDS, 0))
            flat = _signed(np.concatenate([np.zeros(0, np.uint64), *bands]))
            upto = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes])))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array(np.concatenate([np.zeros(0, np.int64), *ns])),
                pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *cs]))),
                pa.ListArray.from_arrays(pa.array(upto), pa.array(flat))], names=["doc_id", "text_hash", "n_shingles", "class", "bands"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    return src.mapInArrow(task, "doc_id long, text_hash long, n_shingles long, class long, bands array<long>")


def families(sigs: DataFrame) -> DataFrame:
    """(class, family) of classes that share a band with another class."""
    rows = sigs.where("n_shingles > 0").select("class", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("class").alias("hub"), F.max("class").alias("top")).where("hub < top")
    edges = rows.join(shared.select("band", "hub"), "band").where("class <> hub") \
        .select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("class"), F.col("component").alias("family"))


def _links(texts: pa.Array, classes: np.ndarray, known: np.ndarray, left: np.ndarray, k: int, percent: int) -> Iterator[tuple[int, int]]:
    """Links between the components ``known`` of a group: pairs of classes with
    100 * intersection >= percent * union, one end of them in ``left``; only
    those that join two components, with those found before them."""
    data, offsets = raw(texts)
    parts = [shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k) for i, j in slices(offsets)]
    sets = np.concatenate([s for s, _ in parts])
    sizes = np.concatenate([np.diff(b) for _, b in parts])
    own = np.concatenate([set_class(s, b) for s, b in parts])
    n = len(sizes)
    valid = (_signed(own) == classes) & (sizes > 0)  # another text of the same key isn't this class
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(sets, kind="stable")
    _, start, inv, count = np.unique(sets, return_index=True, return_inverse=True, return_counts=True)
    post = owner[order]
    base = np.concatenate(([0], np.cumsum(count)))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    comp = known.copy()
    for i in np.flatnonzero(left & valid):
        away = comp != comp[i]
        if not (away & valid).any():
            continue
        ids = inv[bounds[i]:bounds[i + 1]]
        ids = ids[count[ids] > 1]
        lens = count[ids]
        if not len(ids):
            continue
        upto = np.cumsum(lens)
        at = np.repeat(base[ids] - upto + lens, lens) + np.arange(upto[-1])
        both = np.bincount(post[at], minlength=n)
        union = sizes + sizes[i] - both
        for j in np.flatnonzero(away & valid & (100 * both >= percent * union)):
            if comp[j] != comp[i]:
                comp[comp == comp[j]] = comp[i]
                yield int(classes[i]), int(classes[j])


def _verify(grouped, k: int, percent: int) -> DataFrame:
    def task(t: pa.Table) -> pa.Table:
        got = list(_links(t.column("text"), t.column("class").to_numpy(), t.column("known").to_numpy().copy(),
                          t.column("left").to_numpy(), k, percent))
        return pa.table({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([y for _, y in got], pa.int64())})

    return grouped.applyInArrow(task, "a long, b long")


def verified_links(members: DataFrame, k: int, percent: int, deals: int = 2) -> DataFrame:
    """(a, b): links between classes that give every family its components.
    ``members``: (family, class, n, rows, weight, text), one row per class with
    its family's size. Texts are shuffled only into groups of bounded size."""
    with_known = members.withColumns({"known": F.col("class"), "left": F.lit(True)})
    found = None
    for deal in range(deals):
        parts = chunked(with_known, "class", GROUP_ROWS, GROUP_SHINGLES, deal)
        if deal:
            parts = parts.where("chunks > 1")  # a family of one part is done after the first deal
        links = _verify(parts.select("family", "chunk", "class", "text", "known", "left").groupBy("family", "chunk"), k, percent)
        found = links if found is None else found.unionByName(links)
    found = written(found)
    # What the deals left apart in families of several parts, against all of the family.
    known = components(found).withColumnRenamed("node", "class")
    big = chunked(members.drop("text"), "class", GROUP_ROWS // 2, GROUP_SHINGLES // 2).where("chunks > 2") \
        .join(known, "class", "left").withColumn("known", F.coalesce("component", "class")).drop("component")
    counts = big.groupBy("family", "known").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("family").agg(F.max(F.struct("c", "known"))["known"].alias("main"))
    big = attach(big, largest, "family").withColumn("left", F.col("known") != F.col("main"))
    apart = big.where("left")
    blocks = apart.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / (GROUP_ROWS // 2)), F.ceil(F.sum("n") / (GROUP_SHINGLES // 2))).cast("int").alias("blocks"))
    big, cols = written(attach(big, blocks, "family")), ["family", "i", "j", "class", "known", "left"]
    every = big.withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "j": F.col("chunk"), "left": F.lit(False)})
    some = big.where("left").withColumns({"i": F.pmod(F.xxhash64(F.lit(99), "class"), F.col("blocks")).cast("int"),
                                          "j": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))})
    plan = every.select(*cols).unionByName(some.select(*cols)).join(members.select("class", "text"), "class")
    return found.unionByName(written(_verify(plan.groupBy("family", "i", "j"), k, percent)))


def _texts_of(texts: DataFrame, of: DataFrame) -> DataFrame:
    """One row (key, text) for each key that may represent a family's class:
    what the join with ``of`` would drop mostly goes before its shuffle."""
    held = texts.sparkSession.sparkContext.broadcast(bloom_filter(of.select("key"), "key", FILTER_BITS))

    def task(batches):
        for b in batches:
            yield b.filter(pa.array(may_hold(held.value, b.column(0).to_numpy())))

    # a repeated row may hold a third of all rows
    return texts.mapInArrow(task, "key long, text string").dropDuplicates(["key"])


def grouped(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id
    (its smallest id), first. The rows that are ``first`` are those of one id
    and one text in each component: the smallest id and of its texts the one of
    the smallest hash. Rows of a null id, which can't be told to be the same
    document, have one first text of their own in each component. A text
    without words is its own component."""
    sigs = written(signatures(docs, shingle, doc_id, text))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = sigs.where("n_shingles > 0").groupBy("class").agg(
        F.min(row).alias("rep"), F.min(F.when(F.col("doc_id").isNull(), F.col("text_hash"))).alias("unnamed"), F.max("n_shingles").alias("n")) \
        .withColumn("key", F.xxhash64("rep.doc_id", "rep.text_hash"))
    of = written(sized(families(sigs).join(classes.drop("rep", "unnamed"), "class"), "family", "n"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .select(F.xxhash64("doc_id", F.xxhash64("text")).alias("key"), "text")
    members = written(of.join(_texts_of(texts, of), "key").select("family", "class", "n", "rows", "weight", "text"))
    joined = components(verified_links(members, shingle, percent))
    named = joined.join(classes.select(F.col("class").alias("node"), "rep", "unnamed"), "node")
    least = named.groupBy("component").agg(F.min("rep").alias("lead"), F.min("unnamed").alias("spare"))
    linked = named.select("node", "component").join(least, "component").select(F.col("node").alias("class"), "lead", "spare")
    final = classes.join(linked, "class", "left").select(
        "class", F.coalesce("lead", "rep").alias("lead"), F.coalesce("spare", "unnamed").alias("spare"))
    # a class may hold a third of all rows
    rows = attach(sigs.where("n_shingles > 0").select("doc_id", "text_hash", "n_shingles", "class"), final, "class")
    named_first = (F.col("doc_id") == F.col("lead.doc_id")) & (F.col("text_hash") == F.col("lead.text_hash"))
    first = F.when(F.col("doc_id").isNull(), F.col("text_hash") == F.col("spare")).otherwise(named_first)
    rows = rows.select("doc_id", "text_hash", "n_shingles", F.col("lead.doc_id").alias("component_id"), first.alias("first"))
    alone = sigs.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return rows.unionByName(alone)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    return grouped(docs, shingle, percent, doc_id, text).select("doc_id", "n_shingles", "component_id") \
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_per_group(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text and other columns) with one row of each component,
    and of its rows of null ids, if it has any, one as well. Repeated rows of an id are one; rows of a null id without words all stay."""
    gone = grouped(docs, shingle, percent).where("not first").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    lone = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # repeated rows go first, so that no key of the join is hot
    rows = docs.where(~lone).withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    return rows.join(gone, same, "left_anti").select(docs.columns).unionByName(docs.where(lone))
