"""Spark session settings shared by jobs, tests and the bench.

Everything here is a plain builder option. On a cluster the operator of the
cluster owns memory, executors and ``spark.checkpoint.dir``; we only fill in
what is unset.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: a fixed session zone (date strings are derived
# from epoch times), adaptive execution for partition coalescing and skewed
# joins, and Arrow for the few pandas hand-offs.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target shuffle partition size after AQE coalescing.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Lineage cuts written to spark.checkpoint.dir are removed once unused.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "martflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's core settings.

    ``partitions`` sizes ``spark.sql.shuffle.partitions``; AQE coalesces small
    partitions at run time, so on a cluster give adaptive execution room
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``) rather than
    a number per job.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    if master and master.startswith("local"):
        # Local mode runs every task inside the driver JVM.
        conf["spark.driver.memory"] = "8g"
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and streaming state, as set
    in ``spark.checkpoint.dir``. There is no fallback: a folder of this
    machine, or a fresh one per process, would lose offsets and state."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return d
