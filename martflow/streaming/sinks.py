"""Sinks (K1-K10) and micro-batch writers.

Topic sinks use Spark's Kafka writer (at-least-once; downstream tables are
keyed so replays are idempotent). Table sinks are file tables written per
micro-batch inside ``foreachBatch``, with the batch id making a retried
batch overwrite its own output instead of duplicating it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import logsplit, state


def _ckpt(spark: SparkSession, name: str) -> str:
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


# --------------------------------------------------------------------------
# topics (K1, K2, K3, K10)
# --------------------------------------------------------------------------

def kafka_options(servers: str, idempotent: bool = True) -> dict[str, str]:
    """K3: producer settings for an idempotent, fully acknowledged writer."""
    opts = {"kafka.bootstrap.servers": servers}
    if idempotent:
        opts.update({"kafka.acks": "all", "kafka.enable.idempotence": "true",
                     "kafka.retries": str(2**31 - 1)})
    return opts


def to_topic(df: DataFrame, servers: str, topic: str | None = None, name: str = "topic_sink",
             idempotent: bool = True, trigger: str | None = None):
    """K1 (fixed topic) / K2 (per-row ``topic`` column) / K10 (dirty
    records): rows become JSON values. Without ``topic`` each row's
    ``topic`` column picks its destination."""
    cols = [c for c in df.columns if c != "topic"]
    value = F.col("value") if cols == ["value"] else F.to_json(F.struct(*cols))
    out = df.select(*(["topic"] if topic is None else []), value.alias("value"))
    w = out.writeStream.format("kafka").option("checkpointLocation", _ckpt(df.sparkSession, name))
    for k, v in kafka_options(servers, idempotent).items():
        w = w.option(k, v)
    if topic is not None:
        w = w.option("topic", topic)
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def routed_to_files(routed: DataFrame, path: str, mode: str = "append") -> None:
    """K2, file form: rows of many sink tables written under
    ``sink_table=...`` folders in one pass."""
    routed.withColumn("data", F.to_json("data")).write.mode(mode).partitionBy("sink_table").json(path)


def console(df: DataFrame):
    """K9: debug print of a stream."""
    return df.writeStream.format("console").option("truncate", "false").start()


# --------------------------------------------------------------------------
# upsert table (K4 / K6): changes are appended, the table is a fold over them
# --------------------------------------------------------------------------

def run_of(batch: DataFrame) -> str:
    """The run a micro-batch belongs to: its query's id, which the checkpoint
    keeps. Batches of a stream that starts anew, with another checkpoint, count
    from 0 again under another run, so they never meet the old ones."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_folder(batch: DataFrame, batch_id: int) -> str:
    return f"run={run_of(batch)}/batch={batch_id}"


def append_changes(batch: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch's change rows, in a folder of its own. A retried batch
    replaces its own folder; nothing stored is read or rewritten, so a read
    error can't lose rows."""
    batch.write.mode("overwrite").parquet(f"{path}/kind=change/{batch_folder(batch, batch_id)}")


BASES = "_bases"  # published bases, hidden from the table's own listing
BASE_SCHEMA = "base string, run string, upto long"


def _published(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """(number, rows) of the newest published base: which base it is, and up to
    which batch it covers each run."""
    try:
        rows = spark.read.schema(f"{BASE_SCHEMA}, n long").parquet(f"{path}/{BASES}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, spark.createDataFrame([], f"{BASE_SCHEMA}, n long")
    n = rows.agg(F.max("n")).first()[0]
    return (-1, rows.limit(0)) if n is None else (n, rows.where(F.col("n") == n))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows with kind, run and batch; a base's run is its name."""
    return spark.read.option("mergeSchema", "false").parquet(path).withColumn("run", F.col("run").cast("string"))


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The rows whose fold is the table: the newest published base and the
    change batches that it doesn't cover. Which folders those are is decided
    from the partition columns, so others aren't scanned."""
    _, covered = _published(spark, path)
    base = covered.select("base").distinct()
    upto = F.broadcast(covered.select(F.col("run").alias("__run"), "upto"))  # a row per run of the stream
    rows = _stored(spark, path)
    new = rows.where("kind = 'change'").join(upto, (F.col("run") == F.col("__run")) & (F.col("batch") <= F.col("upto")), "left_anti")
    old = rows.where("kind = 'base'").join(F.broadcast(base), F.col("run") == F.col("base"), "left_semi")
    return old.unionByName(new).drop("kind", "run", "batch")


def compact(spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], upto: dict[str, int] | None = None) -> None:
    """Folds the table, as far as its change batches are complete, into a new
    base and then publishes it; until then, and if it never is, readers use the
    base before. ``upto``: the last complete batch of each run (all that are
    stored, if not given: only while no stream writes). ``fold`` must give rows
    of the same schema whose fold is the same (keep tombstones: an older change
    may still arrive). Folders that the published base covers can be deleted."""
    n, covered = _published(spark, path)
    rows = _stored(spark, path)
    stored = rows.where("kind = 'change'").groupBy("run").agg(F.max("batch").cast("long").alias("upto"))
    if upto is not None:
        stored = spark.createDataFrame(list(upto.items()), "run string, upto long")
    marks = stored.unionByName(covered.select("run", "upto")).groupBy("run").agg(F.max("upto").alias("upto"))
    marks = spark.createDataFrame([(r["run"], r["upto"]) for r in marks.collect()], "run string, upto long")  # a row per run
    late = rows.where("kind = 'change'").join(F.broadcast(marks.withColumnRenamed("run", "__run")), (F.col("run") == F.col("__run")) & (F.col("batch") <= F.col("upto")), "left_semi")
    done = F.broadcast(covered.select(F.col("run").alias("__run"), F.col("upto").alias("__upto")))
    late = late.join(done, (F.col("run") == F.col("__run")) & (F.col("batch") <= F.col("__upto")), "left_anti")
    old = rows.where("kind = 'base'").join(F.broadcast(covered.select("base").distinct()), F.col("run") == F.col("base"), "left_semi")
    name = uuid.uuid4().hex
    fold(old.unionByName(late).drop("kind", "run", "batch")).write.parquet(f"{path}/kind=base/run={name}/batch=0")
    marks.select(F.lit(name).alias("base"), "run", "upto").coalesce(1).write.parquet(f"{path}/{BASES}/n={n + 1}")


def upsert_batch(batch: DataFrame, batch_id: int, path: str, key, order) -> None:
    """K4: one micro-batch, reduced to its last record per key, appended."""
    append_changes(state.keep_latest(batch, [key] if isinstance(key, str) else list(key), order), batch_id, path)


def read_upsert_table(spark: SparkSession, path: str, key, order, op_col: str | None = None) -> DataFrame:
    """Current contents of an upsert table: the last record per key under the
    same ``order`` within and across batches, less the deleted keys."""
    rows = state.keep_latest(read_changes(spark, path), [key] if isinstance(key, str) else list(key), order)
    return rows.where(F.coalesce(F.col(op_col), F.lit("")) != "d") if op_col else rows


def compact_upsert_table(spark: SparkSession, path: str, key, order, upto: dict[str, int] | None = None) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    compact(spark, path, lambda rows: state.keep_latest(rows, keys, order), upto)


def upsert_stream(stream: DataFrame, path: str, key, order, name: str, trigger: str | None = None):
    """K4 on a stream: ``foreachBatch`` append with a checkpoint."""
    fn: Callable = lambda b, i: upsert_batch(b, i, path, key, order)
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", _ckpt(stream.sparkSession, name))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


# --------------------------------------------------------------------------
# multi-output log split (R1) and table append (K5)
# --------------------------------------------------------------------------

def split_log_batch(batch: DataFrame, batch_id: int, base: str, repair: bool = False) -> None:
    """R1 inside ``foreachBatch``: parse the micro-batch once (persisted),
    write the five outputs and the dirty lines as JSON text, then release.
    Each output of a batch goes to ``<base>/<name>/run=<run>/batch=<id>`` so a retried
    batch replaces its own files. The new-visitor repair needs keyed state
    across batches, so it is off here; ``apps.log_split_app`` is the full job
    (stateful repair before the split). ``repair=True`` repairs within the
    batch only (for one-off backfills of a complete log)."""
    batch.persist()
    try:
        parts = logsplit.split_log(batch, repair=repair)
        for name, df in parts.items():
            out = df if name == "dirty" else logsplit.to_json_lines(df)
            out.write.mode("overwrite").text(f"{base}/{name}/{batch_folder(batch, batch_id)}")
    finally:
        batch.unpersist()


def split_log_stream(raw: DataFrame, base: str, name: str = "log_split", trigger: str | None = None):
    w = raw.writeStream.foreachBatch(lambda b, i: split_log_batch(b, i, base)) \
           .option("checkpointLocation", _ckpt(raw.sparkSession, name))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def append_table(stream: DataFrame, path: str, name: str, fmt: str = "parquet", trigger: str | None = None):
    """K5: windowed results appended to a table (file sink: exactly once)."""
    w = (stream.writeStream.format(fmt).outputMode("append").option("path", path)
         .option("checkpointLocation", _ckpt(stream.sparkSession, name)))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
