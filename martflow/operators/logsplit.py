"""DWD log split.

Raw log lines are parsed once; lines that are not JSON go to the dirty
output. Parsed records get the new-visitor repair (T1) and are split:

* ``err``     -- every record carrying ``err``, whole (with ``err``);
* ``start``   -- records with ``start`` (without ``err``);
* ``display`` -- one row per element of ``displays`` of a page record,
  with the record's ``common``, ``page`` and ``ts`` (P11);
* ``action``  -- one row per element of ``actions`` with ``common`` and
  ``page`` -- and no ``ts`` (P12, Q6);
* ``page``    -- page records without ``err``, ``displays``, ``actions`` (P13).

A record can feed several outputs. In a stream the split runs inside one
``foreachBatch`` over a persisted micro-batch, so the parse happens once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.applog import LOG_SCHEMA
from ..sources.cdc import parse_json
from . import state


def parse_logs(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed records, dirty lines)."""
    return parse_json(raw, LOG_SCHEMA, col)


def repair_logs(logs: DataFrame) -> DataFrame:
    """T1 applied to log records: keyed by ``common.mid``, ordered by
    ``ts`` then ``common.sid``; rewrites ``common.is_new``."""
    flat = logs.withColumn("__mid", F.col("common.mid")).withColumn("__sid", F.col("common.sid")) \
               .withColumn("__is_new", F.col("common.is_new")) \
               .withColumn("__ts", F.timestamp_millis("ts"))
    fixed = state.repair_is_new(flat, "__mid", "__ts", ["__sid"], flag="__is_new")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("__is_new"))) \
                .drop("__mid", "__sid", "__is_new", "__ts")


def split_log(raw: DataFrame, repair: bool = True) -> dict[str, DataFrame]:
    """The five outputs plus ``dirty``, as DataFrames of records."""
    logs, dirty = parse_logs(raw)
    if repair:
        logs = repair_logs(logs)
    return {**split_records(logs), "dirty": dirty}


def split_records(logs: DataFrame) -> dict[str, DataFrame]:
    """R1 over parsed (and repaired) records: the five outputs."""
    err = logs.where(F.col("err").isNotNull())
    rest = logs.drop("err")
    start = rest.where(F.col("start").isNotNull())
    pages = rest.where(F.col("start").isNull())
    display = pages.select("common", "page", F.explode("displays").alias("display"), "ts")
    action = pages.select("common", "page", F.explode("actions").alias("action"))
    page = pages.drop("displays", "actions", "start")
    return {"err": err, "start": start, "display": display, "action": action, "page": page}


def to_json_lines(df: DataFrame) -> DataFrame:
    """records -> JSON text (null fields omitted), ready for a topic."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
