"""Connected components of an edge table, and blocks of bounded groups."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edges that one task contracts on its own.
LOCAL_EDGES = 500_000


class Union:
    """Disjoint sets of integers; the smallest member names its set."""

    def __init__(self):
        self.up: dict = {}

    def find(self, a):
        while (b := self.up.get(a, a)) != a:
            self.up[a] = self.up.get(b, b)
            a = b
        return a

    def join(self, a, b) -> bool:
        """Whether they were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _contract(batches):
    """A task's edges as stars of its own components: an edge for each node at most."""
    sets = Union()
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            sets.join(x, y)
    nodes = list(sets.up)
    pairs = [(x, r) for x in nodes if (r := sets.find(x)) != x]
    for i in range(0, len(pairs), 50_000):
        part = pairs[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.int64())], names=["a", "b"])


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or linked to one centre only."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("centre")))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre"))
    return nodes.where("up + centre > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long), where
    component is the smallest node reachable.

    First each task contracts ``LOCAL_EDGES`` edges or so to stars by itself.
    Then, as long as some node lies in two stars, large-star and small-star
    alternate: every node's greater (smaller) neighbours are linked to its
    smallest one, until each component is a star.
    Each step is an aggregate with map-side combine and a join on the node. A
    hub of any degree is combined first and split by the skew join; after the
    first half of a round a node's edges lead to few centres. The number of
    rounds grows with the logarithm of the longest path. Rounds are cut by
    tables in the shared folder. Empty edges give an empty table.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    # a > b throughout
    now = written(edges.where("a <> b").select(most.alias("a"), least.alias("b")).distinct())
    now = written(now.coalesce(max(1, -(-now.count() // LOCAL_EDGES))).mapInArrow(_contract, "a long, b long"))
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hub = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = attach(both.where("b > a"), hub, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").where("a <> b").distinct()
        now = written(small)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def attach(df: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Inner join of each row with its key's row of an aggregate. The join is
    on a struct of the key, so that the aggregate is shuffled once more and
    both sides are plain shuffles: only then does the skew join split a key
    that holds most of ``df``."""
    return df.withColumn("__key", F.struct(key)).join(per_key.withColumn("__on", F.struct(key)).drop(key), F.col("__key") == F.col("__on")).drop("__key", "__on")


def sized(members: DataFrame, group: str, weight: str) -> DataFrame:
    """``members`` (narrow rows) with ``rows`` and ``weight`` of their group."""
    return attach(members, members.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("weight")), group)


def chunked(members: DataFrame, id_: str, rows: int, weights: int, salt: int = 0) -> DataFrame:
    """Rows of :func:`sized` with ``chunks``, the number of parts that their
    group needs so that a part has about ``rows`` rows and ``weights`` weight,
    and ``chunk``, the part (by a hash of the id and ``salt``) they belong to."""
    need = F.greatest(F.ceil(F.col("rows") / rows), F.ceil(F.col("weight") / weights), F.lit(1)).cast("int")
    return members.withColumn("chunks", need).withColumn("chunk", F.pmod(F.xxhash64(F.lit(salt), id_), F.col("chunks")).cast("int"))


def chunk_pairs(parts: DataFrame) -> DataFrame:
    """Each row of :func:`chunked` once for every pair of its chunk with a chunk
    of its group: columns ``i`` <= ``j`` name the pair."""
    other = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return other.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("other")
