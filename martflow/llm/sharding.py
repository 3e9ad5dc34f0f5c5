"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

Rows are dealt into logical partitions by a hash. Each partition's row count
is known after one aggregation; a multivariate hypergeometric draw per
partition, without replacement from what the shards still lack, fixes how many
of its rows go to which shard. Every partition permutes its rows at random and
sends the first ones to shard 0, the next to shard 1, and so on; every shard
permutes what it got. Together that is a uniform permutation of all rows, cut
into shards whose sizes differ by one row at most.

All of this is drawn for narrow rows, a 128-bit hash of a row's columns and a
copy number; whole rows are shuffled once, to the places that were drawn for
them. Rows equal in all columns (with a null or repeated id, say) are counted
first, so each copy has random keys of its own and a group of them is spread like
other rows; a group's copies are made from one row at the end. Which of two
equal rows gets which place doesn't matter, and nothing depends on the order in
which rows are fetched, so a task that runs again gives the same.

Only DataFrame functions touch rows. The driver sees one count per logical
partition (one per ``cell_rows`` rows) and draws the matrix.

The second permutation must not sort a whole shard in one task: a row's second
random key deals it into one of the shard's cells; counted cells give offsets;
within its cell a row is placed by the key. Uniform random cells followed by
a uniform order inside each are a uniform order of the shard.

Defined results: null and empty texts are rows like others; equal rows each get
their own place; an empty table gives an empty table; columns of the input that
are called like a result column are replaced by it. Columns must be of types that
can be hashed (no maps).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Counts at most one apart, the larger ones first."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], dtype=np.int64)


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """matrix[p, s]: rows that partition p sends to shard s. Row sums are
    ``counts``, column sums :func:`shard_sizes`; exact draws without
    replacement, one partition after the other."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = shard_sizes(sum(counts), shards)
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for p, n in enumerate(counts):
        rest, total = n, int(left.sum())
        for s in range(shards):
            lacks = int(left[s])
            total -= lacks
            # conditional draws, shard by shard
            k = _hypergeometric(rng, lacks, total, rest)
            out[p, s] = k
            left[s] -= k
            rest -= k
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    low, high = max(0, draws - bad), min(good, draws)
    if low >= high:
        return low
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    # Beyond numpy's range: inversion, outward from the mode.
    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    p = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u, up, down, p_up, p_down = rng.random() - p, mode, mode, p, p
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def _key(seed: int, salt: int) -> Column:
    """A random long of each copy."""
    return F.xxhash64(F.lit(seed + salt), "k1", "k2", "copy")


def places(classes: DataFrame, rows: int, shards: int, seed: int, cell_rows: int) -> DataFrame:
    """(k1, k2, copy, shard, slot) of every copy of ``classes`` (k1, k2, n)."""
    spark = classes.sparkSession
    parts, cells = max(1, -(-rows // cell_rows)), max(1, -(-rows // (shards * cell_rows)))
    step = 1 << 12  # copies are counted out in two steps, so that no array is long
    some = classes.select("k1", "k2", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / step))).alias("lot"))
    copies = some.select("k1", "k2", F.explode(F.sequence(F.col("lot") * step, F.least((F.col("lot") + 1) * step, "n") - 1)).alias("copy"))
    dealt = copies.withColumn("part", F.pmod(_key(seed, 1), F.lit(parts)).cast("int"))

    counted = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    upto = np.cumsum(communication_matrix([counted.get(p, 0) for p in range(parts)], shards, seed), axis=1)
    table = pa.table({"part": pa.array(np.arange(parts, dtype=np.int32)), "upto": pa.FixedSizeListArray.from_arrays(pa.array(upto.ravel()), shards).cast(pa.list_(pa.int64()))})
    matrix = spark.createDataFrame(table)

    local = Window.partitionBy("part").orderBy(_key(seed, 2), "k1", "k2", "copy")
    sent = dealt.withColumn("pos", F.row_number().over(local)).join(matrix, "part") \
        .withColumn("shard", F.size(F.filter("upto", lambda x: x < F.col("pos"))).cast("int")) \
        .withColumn("cell", F.pmod(_key(seed, 3), F.lit(cells)).cast("int")) \
        .select("k1", "k2", "copy", "shard", "cell")
    sizes = sent.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "cell").orderBy(_key(seed, 4), "k1", "k2", "copy")
    return sent.withColumn("place", F.row_number().over(inside)).join(offsets, ["shard", "cell"]) \
        .select("k1", "k2", "copy", "shard", (F.col("offset") + F.col("place") - 1).alias("slot"))


def hypergeometric_shards(df: DataFrame, shards: int, seed: int = 20240601, cell_rows: int = 100_000) -> DataFrame:
    """``df`` with ``shard`` int (0 to shards - 1) and ``slot`` long (gapless
    from 0 within the shard). ``cell_rows``: narrow rows per logical partition
    and per cell."""
    cols = [c for c in df.columns if c not in ("shard", "slot")]
    quoted = [F.col(f"`{c}`") for c in cols]
    rows = df.select(F.struct(*quoted).alias("row"), F.xxhash64(*quoted).alias("k1"), F.xxhash64(F.lit(seed), *quoted).alias("k2"))
    classes = written(rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")))
    n = classes.agg(F.sum("n")).first()[0] or 0
    drawn = written(places(classes, n, shards, seed, cell_rows)
                    .join(classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "n"), (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")))
                    .select(F.struct("k1", "k2").alias("key"), "copy", "n", "shard", "slot")) if n else None
    if drawn is None:
        return df.select(*quoted, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # one row per class beside the rows themselves: both sides of the join are plain shuffles
    own = drawn.where("copy = 0").select(F.col("key").alias("own"), "n", "shard", "slot")
    whole = rows.select("row", F.struct("k1", "k2").alias("key")).join(own, F.col("key") == F.col("own"))
    alone = whole.where("n = 1").select("row", "shard", "slot")
    if not drawn.where("n > 1").limit(1).count():
        return alone.select("row.*", "shard", "slot")
    # copies: one row of each group, and as many places as it has copies
    one = whole.where("n > 1").groupBy("key").agg(F.first("row").alias("row"), F.first("n").alias("n"))
    lots = one.select("row", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 4096))).alias("lot"), "key") \
        .select("row", F.struct("key", "lot").alias("at"))
    rest = drawn.where("n > 1").select(F.struct("key", F.floor(F.col("copy") / 4096).alias("lot")).alias("to"), "shard", "slot")
    copied = lots.join(rest, F.col("at") == F.col("to")).select("row", "shard", "slot")
    return alone.unionByName(copied).select("row.*", "shard", "slot")
