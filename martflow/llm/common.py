"""Session helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch: whole documents of some kB each, so that a batch of
#: long texts still fits a Python worker.
BATCH_ROWS = 256


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings, and the folder of this library on the Python workers'
    path (where the cluster installs it or ships it with --py-files, that is
    found first or as well)."""
    path = [x for x in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in path:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*path, ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``. Only a
    session that has none (tests) gets one of its own."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.mkdtemp(prefix="martflow-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's own removal of a statement's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Cuts the lineage: ``df`` as a Parquet table in the shared folder. The
    write's shuffle files go with it: nothing reads them again."""
    spark = df.sparkSession
    path = shared_folder(spark)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        w.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def dropped(table: DataFrame) -> None:
    """Removes the files of a ``written`` table (or a union of some) that nothing reads again."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def held_out(doc_id: str, mod: int, rest: int = 2):
    """True where crc32 of the id's decimal text leaves ``rest``; a null id
    counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def bloom_filter(df: DataFrame, hashed: str, bits: int) -> np.ndarray:
    """Bloom filter (three bits a key, ``bits`` a power of two) of a column of
    64-bit hashes, united by Spark; ``bits`` / 64 words reach the driver at most."""
    places = [F.shiftrightunsigned(hashed, s).bitwiseAND(F.lit(bits - 1)) for s in (0, 21, 42)]
    words = df.select(F.explode(F.array(*places)).alias("p")) \
        .groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).collect()
    out = np.zeros(bits // 64, dtype=np.uint64)
    for r in words:
        out[r["w"]] = np.uint64(r["v"] & 0xFFFFFFFFFFFFFFFF)
    return out


def may_hold(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes may be in the filter (none that is, is missed)."""
    hit = np.ones(len(h), dtype=bool)
    h, m = h.view(np.uint64), np.uint64(len(bloom) * 64 - 1)
    for s in (0, 21, 42):
        p = ((h[hit] >> np.uint64(s)) & m).astype(np.int64)
        hit[hit] = (bloom[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) != 0
    return hit
