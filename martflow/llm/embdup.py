"""Near-duplicate vectors by sorted projection passes.

Identical vectors are one class from the start. In every pass each class gets
a key of concatenated random hashes (signs of random projections). Classes that
share a key's first bits are a run, and a run is compared as a whole, by cosine
in double precision, in blocks of bounded size, however dense or long it is.
Two vectors agree in a bit with probability 1 - angle / pi, so :func:`plan`
can derive from the number of classes how many bits keep runs of unrelated
vectors short, and how many passes then put a pair at the threshold into a
common run but for a share of ``MISS``; few classes are compared all with all.
Before that, classes are range-partitioned and sorted lexicographically by
their keys and compared with their neighbours in a bounded window; that finds
most links cheaply, and runs that lie inside one component by then are left out.
Links of all passes are united into components; inside one, all links are then
counted exactly, in blocks of bounded size.

Defined results: a vector that is null, empty or all zero, or holds a null or
non-finite component, links with nothing (n_links 0, its own component);
vectors of different lengths don't link; repeated rows each give a row and link
with each other; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import Union, attach, chunk_pairs, chunked, components, sized

#: Share of the pairs at the threshold that no run of any pass holds.
MISS = 1e-6
WINDOW = 32
KEY_BITS = 63
GROUP_ROWS = 1024


def plan(classes: int, least: float, block: int) -> tuple[int, int]:
    """(bits of a run's prefix, passes). Runs of unrelated vectors have
    ``block`` rows or so (a quarter of the classes, if they are few); a pair of
    cosine ``least`` shares no run of any pass with probability ``MISS`` at most."""
    bits = min(KEY_BITS, max(2, math.ceil(math.log2(max(1, classes) / block))))
    meet = (1 - math.acos(min(1.0, max(-1.0, least))) / math.pi) ** bits
    return bits, 1 if meet >= 1 else math.ceil(math.log(MISS) / math.log1p(-meet))


def matrix(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit rows in double precision) for each vector length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.asarray(col.value_lengths())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    out = []
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        x = flat[first[rows][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out.append((rows, x / np.linalg.norm(x, axis=1, keepdims=True)))
    return out


def pass_keys(x: np.ndarray, passes: int) -> np.ndarray:
    """(rows, passes) int64 keys: sign bits of random projections, first bit highest."""
    d = x.shape[1]
    out = np.zeros((len(x), passes), dtype=np.int64)
    for p in range(passes):
        r = np.random.Generator(np.random.PCG64([d, p])).normal(size=(d, KEY_BITS))
        bits = (x @ r) >= 0
        for b in range(KEY_BITS):
            out[:, p] = out[:, p] << 1 | bits[:, b]
    return out


def window_links(sorted_rows: DataFrame, window: int, least: float) -> DataFrame:
    """Links that join components of a sorted partition, from windows of
    ``window`` rows within the same pass and length."""
    def task(batches):
        held, seen = None, Union()
        for b in batches:
            now = pa.Table.from_batches([b])
            t = now if held is None else pa.concat_tables([held, now])
            old = 0 if held is None else held.num_rows
            part, ident = t.column("pass").to_numpy(), t.column("class").to_numpy()
            a_out, b_out = [], []
            for rows, x in matrix(t.column("vec")):
                for o in range(1, min(window, len(rows) - 1) + 1):
                    i, j = rows[o:], rows[:-o]
                    near = (i - j <= window) & (i >= old) & (part[i] == part[j])
                    if not near.any():
                        continue
                    at = np.flatnonzero(near)
                    cos = np.einsum("ij,ij->i", x[o:][at], x[:-o][at])
                    for k in at[cos >= least]:
                        u, v = int(ident[i[k]]), int(ident[j[k]])
                        if seen.join(u, v):
                            a_out.append(u)
                            b_out.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
            held = t.slice(max(0, t.num_rows - window))

    return sorted_rows.mapInArrow(task, "a long, b long")


def _with_keys(reps: DataFrame, passes: int, kind: str) -> DataFrame:
    def task(batches):
        for b in batches:
            keys = np.zeros((b.num_rows, passes), dtype=np.int64)
            for rows, x in matrix(b.column(1)):
                keys[rows] = pass_keys(x, passes)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(
                pa.array(np.arange(0, passes * b.num_rows + 1, passes), pa.int32()), pa.array(keys.ravel()))], names=["class", "vec", "keys"])

    return reps.select("class", "vec").mapInArrow(task, f"class long, vec {kind}, keys array<long>")


def _run_parts(keyed: DataFrame, known: DataFrame, bits: int, classes: int, block: int) -> DataFrame:
    """(run, class, known, chunk, chunks): narrow rows of the runs that hold
    more than one component of ``known``."""
    rows = keyed.join(known, "class", "left").withColumn("known", F.coalesce("component", "class"))
    if not bits:
        one = rows.select("class", "known", F.lit(0).cast("long").alias("run"), *(F.lit(classes).alias(c) for c in ("rows", "weight")))
        return chunked(one, "class", block, 1 << 62)
    exploded = rows.select("class", "known", F.size("vec").alias("dim"), F.posexplode("keys").alias("pass", "key"))
    runs = exploded.select("class", "known", F.xxhash64("pass", "dim", F.shiftright("key", KEY_BITS - bits)).alias("run"))
    mixed = runs.groupBy("run").agg(F.count(F.lit(1)).alias("rows"), F.min("known").alias("low"), F.max("known").alias("high")) \
        .where("low < high").select("run", "rows", F.col("rows").alias("weight"))
    return chunked(attach(runs, mixed, "run"), "class", block, 1 << 62)


def _run_links(pairs, least: float) -> DataFrame:
    """Links between two blocks of a run that join components not yet joined."""
    def task(t: pa.Table) -> pa.Table:
        ident, comp = t.column("class").to_numpy(), t.column("known").to_numpy().copy()
        chunk, i, j = t.column("chunk").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        a_out, b_out = [], []
        for rows, x in matrix(t.column("vec")):
            left, right = np.flatnonzero(chunk[rows] == i), np.flatnonzero(chunk[rows] == j)
            near = x[left] @ x[right].T >= least
            for k in np.flatnonzero(near.any(axis=1)):
                u, others = rows[left[k]], rows[right[near[k]]]
                for v in others[comp[others] != comp[u]]:
                    if comp[v] != comp[u]:
                        a_out.append(ident[u])
                        b_out.append(ident[v])
                        comp[comp == comp[v]] = comp[u]
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return pairs.applyInArrow(task, "a long, b long")


def _count_links(pairs, least: float) -> DataFrame:
    """Per class and block pair: rows linked with it, its own class left out."""
    def task(t: pa.Table) -> pa.Table:
        ident, copies = t.column("class").to_numpy(), t.column("copies").to_numpy()
        chunk, i, j = t.column("chunk").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        links = np.zeros(len(ident), dtype=np.int64)
        for rows, x in matrix(t.column("vec")):
            left, right = chunk[rows] == i, chunk[rows] == j
            near = x[left] @ x[right].T >= least
            near &= ident[rows][left][:, None] != ident[rows][right][None, :]
            links[rows[left]] += near @ copies[rows][right]
            if i != j:
                links[rows[right]] += near.T @ copies[rows][left]
        return pa.table({"class": ident, "links": links})

    return pairs.applyInArrow(task, "class long, links long")


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.9, vec_id: str = "vec_id", vec: str = "embedding",
                           passes: int | None = None, window: int = WINDOW) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.
    ``passes``: more or fewer than :func:`plan` derives."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"))
    if src.schema["vec"].dataType.simpleString() not in ("array<float>", "array<double>"):
        src = src.withColumn("vec", F.col("vec").cast("array<double>"))
    src = src.withColumn("ok", F.coalesce((F.size("vec") > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = src.withColumn("class", F.when(F.col("ok"), F.xxhash64("vec")))
    kind = src.schema["vec"].dataType.simpleString()
    reps = written(rows.where("ok").groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")))
    block, classes = GROUP_ROWS // 2, reps.count()
    bits, needed = plan(classes, least, block)
    hashed = _with_keys(reps, passes or needed, kind)
    keyed = hashed.select("class", "vec", F.size("vec").alias("dim"), F.posexplode("keys").alias("pass", "key"))
    by = ["pass", "dim", "key", "class"]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    near = written(window_links(ordered, window, least))
    known = components(near).withColumnRenamed("node", "class")
    runs = chunk_pairs(_run_parts(hashed, known, bits, classes, block)).join(reps.select("class", "vec"), "class")
    found = components(near.unionByName(written(_run_links(runs.groupBy("run", "i", "j"), least))))
    narrow = sized(found.withColumnRenamed("node", "class").join(reps.drop("vec"), "class"), "component", "copies")
    least_id = narrow.groupBy("component").agg(F.min("rep").alias("component_id"))
    members = written(attach(narrow, least_id, "component"))
    parts = chunked(members, "class", block, 1 << 62)
    pairs = chunk_pairs(parts).join(reps.select("class", "vec"), "class").groupBy("component", "i", "j")
    counted = _count_links(pairs, least).groupBy("class").agg(F.sum("links").alias("links"))
    linked = members.select("class", "component_id").join(counted, "class")
    per_class = reps.select("class", "rep", "copies").join(linked, "class", "left").select(
        "class", F.coalesce("component_id", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    good = rows.where("ok").select("vec_id", "class").join(per_class, "class").select("vec_id", "n_links", "component_id")
    bad = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id") == F.col("component_id"))
