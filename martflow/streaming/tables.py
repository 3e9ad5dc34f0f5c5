"""K7: a change feed of configuration creates, drops and recreates catalog tables.

``r`` and ``c`` create the sink table if it isn't there, ``d`` drops it, ``u`` drops
and creates it anew (its rows go, its columns may differ). A micro-batch's
changes are first folded to one action per table: what counts is the last
change, and whether the table had to go at some point before it. The time of the
change that made a table is kept as a table property, so a batch that is run
again, wholly or from the middle, finds its work done and leaves rows alone that
were written in between.

The folded changes are as many as there are sink tables; DDL is the driver's.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQ = "martflow.config_seq"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def _name(x: str) -> str:
    if not x or not _NAME.match(x):
        raise ValueError(f"not a table or column name: {x!r}")
    return f"`{x}`"


def folded_actions(config: DataFrame) -> DataFrame:
    """One row per ``sink_table``: ``op``, ``seq`` and ``sink_columns`` of its last
    change, and ``reset``, the place of the last change that removed the table. A
    place is the change's time and log position as text that sorts."""
    pos = F.col("pos") if "pos" in config.columns else F.lit(0)
    seq = F.format_string("%020d.%010d", F.col("ts_ms"), F.coalesce(pos, F.lit(0)).cast("long"))
    rows = config.where(F.col("sink_table").isNotNull() & F.col("ts_ms").isNotNull() & F.col("op").isin("r", "c", "u", "d")).withColumn("seq", seq)
    last = F.max(F.struct("seq", "op", "sink_columns"))
    reset = F.max(F.when(F.col("op").isin("u", "d"), F.col("seq")))
    return rows.groupBy("sink_table").agg(last.alias("l"), reset.alias("reset")) \
        .select("sink_table", "l.op", "l.seq", "l.sink_columns", "reset")


def _made_at(spark: SparkSession, table: str) -> str | None:
    """Place of the change that made the table; None without a table."""
    if not spark.catalog.tableExists(table.replace("`", "")):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == SEQ).collect()
    return rows[0]["value"] if rows else ""


def apply_config(spark: SparkSession, config: DataFrame, db: str = "default", fmt: str = "parquet") -> dict[str, str]:
    """Applies config changes; returns table -> what was done (created, dropped,
    recreated or kept). Columns are text, as in the change records."""
    done = {}
    for r in sorted(folded_actions(config).collect()):
        table = f"{_name(db)}.{_name(r['sink_table'])}"
        made = _made_at(spark, table)
        if r["op"] == "d":
            if made is not None and made <= r["seq"]:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            done[r["sink_table"]] = "dropped" if made is not None and made <= r["seq"] else "kept"
            continue
        stale = made is not None and r["reset"] is not None and made < r["reset"]
        if made is not None and not stale:
            done[r["sink_table"]] = "kept"
            continue
        if stale:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        cols = ", ".join(f"{_name(c.strip())} STRING" for c in r["sink_columns"].split(","))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {fmt} TBLPROPERTIES ('{SEQ}' = '{r['seq']}')")
        done[r["sink_table"]] = "recreated" if stale else "created"
    return done


def config_tables_stream(configs: DataFrame, checkpoint: str, db: str = "default", fmt: str = "parquet", trigger: dict | None = None):
    """Runs :func:`apply_config` on every micro-batch of a config stream."""
    def write(batch, batch_id):
        apply_config(batch.sparkSession, batch, db, fmt)

    return configs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"processingTime": "0 seconds"})).start()
