"""Config-driven routing of the change feed.

The routing configuration is itself a change feed; its current state
(``state.latest_config``) has one row per routed source table. Business rows
are joined to it. A configuration that is a list in the code carries a
broadcast hint from its source; one read from a table is broadcast if its
bytes say so. Never a driver-side lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cdc, state


# --------------------------------------------------------------------------
# dimensions: R3 + J8 + K7, then the T9 fold
# --------------------------------------------------------------------------

def route_dims(ods: DataFrame, config_feed: DataFrame, db: str | None = None) -> DataFrame:
    """X1 + P8 + J8 + P5 + K7: each gated change becomes
    ``(sink_table, row_key, op, ts_ms, pos, data)`` where ``data`` is the change's
    image pruned to the configured ``sink_columns``.

    Only source tables present in the current config are routed (inner
    join). K7: a config *update* recreates the sink table, so changes older
    than that update are not applied; a config delete drops the table.
    """
    cfg = state.latest_config(config_feed, "source_table", "ts_ms").select(
        "source_table", "sink_table", "sink_columns", "sink_row_key",
        F.col("op").alias("__cfg_op"), F.col("ts_ms").alias("__cfg_ts"))
    g = cdc.cdc_gate(ods, db).select(F.col("source")["table"].alias("__src"), "op", "ts_ms",
                                     *(["pos"] if "pos" in ods.columns else []), cdc.image().alias("data"))
    j = g.join(cfg, F.col("__src") == F.col("source_table"), "inner")
    j = j.where((F.col("__cfg_op") != "u") | (F.col("ts_ms") >= F.col("__cfg_ts")))
    j = cdc.prune_payload(j, "data", "sink_columns")
    pos = F.col("pos") if "pos" in ods.columns else F.lit(0).cast("bigint").alias("pos")
    return j.select("sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op", "ts_ms", pos, "data")


def fold_routed_dims(routed: DataFrame) -> DataFrame:
    """T9 over routed changes of many tables: per (sink_table, row_key) and
    column, the last non-empty value, with deletes resetting the row.
    Output is long: ``(sink_table, row_key, column, value)``.

    Two combinable aggregates -- per cell (:func:`dim_cells`), then per row
    (:func:`dim_rows`) -- so neither a hot row key nor a wide table
    concentrates raw rows in one task.
    """
    return dim_rows(dim_cells(routed))


CELL_SCHEMA = "sink_table string, row_key string, k string, m struct<s:struct<ts:bigint,pos:bigint>,v:string>"


def dim_cells(routed: DataFrame) -> DataFrame:
    """The fold state: per (sink_table, row_key, k) the newest non-empty
    ``m = (s, v)``, s being (time, log position); ``k = '__last'`` holds the row's last change time and
    ``k = '__del'`` its last delete. States of different batches merge with
    :func:`merge_cells` (the same max), whatever order changes arrive in.

    Changes are dealt out before they become cells, several each: a file of
    many short rows is one task's, whose partial max would sort the cells of all
    of them. (Their time is part of the key, so a hot row's changes are spread.)
    """
    nonempty = lambda v: v.isNotNull() & (v != "")
    cells = F.filter(
        F.transform(F.map_entries(F.when(F.col("op") != "d", F.col("data"))),
                    lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))),
        lambda c: nonempty(c["v"]))
    markers = F.array(
        F.struct(F.lit("__last").alias("k"), F.lit(None).cast("string").alias("v")),
        F.when(F.col("op") == "d", F.struct(F.lit("__del").alias("k"), F.lit(None).cast("string").alias("v"))))
    entries = F.concat(F.coalesce(cells, F.array().cast("array<struct<k:string,v:string>>")), markers)
    seq = F.struct(F.col("ts_ms").alias("ts"), F.coalesce("pos", F.lit(0)).cast("bigint").alias("pos"))
    dealt = routed.repartition("sink_table", "row_key", "ts_ms", "pos")
    x = dealt.select("sink_table", "row_key", seq.alias("s"), F.explode(entries).alias("e")).where(F.col("e").isNotNull())
    return x.groupBy("sink_table", "row_key", F.col("e.k").alias("k")) \
            .agg(F.max(F.struct("s", F.col("e.v").alias("v"))).alias("m"))


def merge_cells(*states: DataFrame) -> DataFrame:
    """Merge fold states (associative, commutative)."""
    u = states[0]
    for s_ in states[1:]:
        u = u.unionByName(s_)
    return u.groupBy("sink_table", "row_key", "k").agg(F.max("m").alias("m"))


def dim_rows(cells: DataFrame) -> DataFrame:
    """Visible dimension rows from the fold state: a row lives if its last
    change is newer than its last delete; a cell counts if newer than that
    delete."""
    per_row = cells.groupBy("sink_table", "row_key") \
                   .agg(F.map_from_entries(F.collect_list(F.struct("k", "m"))).alias("mm"))
    dl = F.col("mm")["__del"]["s"]
    last = F.col("mm")["__last"]["s"]
    live = per_row.where(dl.isNull() | (last > dl))
    kept = F.map_filter(F.col("mm"), lambda k, m: ~k.startswith("__") & (dl.isNull() | (m["s"] > dl)))
    out = live.select("sink_table", "row_key", F.explode(kept).alias("column", "m"))
    return out.select("sink_table", "row_key", "column", F.col("m.v").alias("value"))


def fold_dimension_table(feed: DataFrame, key: str, cols) -> DataFrame:
    """T9 for one source table with known columns: flat output."""
    img = cdc.image()
    flat = feed.select("op", F.struct(*cdc.change_order(feed)).alias("seq"), img[key].alias(key),
                       *[img[c].alias(c) for c in cols if c != key])
    return state.fold_dimension(flat, key, [c for c in cols if c != key], "seq", "op")


# --------------------------------------------------------------------------
# facts: R2 + J9 + P5
# --------------------------------------------------------------------------

def route_facts(ods: DataFrame, config_feed: DataFrame) -> DataFrame:
    """J9 + P8 + P5 + R2: changes whose (table, op) is configured become
    ``(sink_table, data)``, ``data`` = image pruned to ``sink_columns`` plus
    ``ts_ms``. Q2: deletes use their before image."""
    cfg = state.latest_config(config_feed, ["source_table", "source_type"], "ts_ms") \
               .select("source_table", "source_type", "sink_table", "sink_columns")
    j = ods.join(cfg, (F.col("source")["table"] == F.col("source_table")) &
                 (F.col("op") == F.col("source_type")), "inner")
    j = j.withColumn("data", cdc.image())
    j = cdc.prune_payload(j, "data", "sink_columns")
    data = F.map_concat(F.col("data"), F.create_map(F.lit("ts_ms"), F.col("ts_ms").cast("string")))
    return j.select("sink_table", data.alias("data"))
