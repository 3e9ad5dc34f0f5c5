"""Re-aimed utilities: day spine (F19), day-partitioned output (K8),
hash buckets (F20), per-key ordered lists (A9), bounded scans (S8) and row
counts (A8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import PARTITION_FMT, event_day
from ..functions.keys import with_hash_bucket


def day_spine(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """every day from ``lo`` to ``hi`` (date columns of each row of
    ``bounds``) inclusive, as an int ``yyyyMMdd``; one row per day."""
    days = bounds.select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"),
                                          F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(F.date_format("d", PARTITION_FMT).cast("int").alias("day"))


def daily_counts_on_spine(df: DataFrame, ts: str) -> DataFrame:
    """F19 applied: per-day row counts of ``df`` on a gap-free day spine
    spanning its first to last day (days without rows get 0). The spine
    comes from a one-row min/max aggregate; the day counts are a combinable
    aggregate; the join is between two day-sized tables."""
    days = df.select(F.col(ts).cast("date").alias("d"))
    rng = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    spine = day_spine(rng, "lo", "hi")
    counts = days.groupBy(F.date_format("d", PARTITION_FMT).cast("int").alias("day")) \
                 .agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def with_event_day(df: DataFrame, value_col: str, out: str = "day") -> DataFrame:
    """K8: the day partition of each row from an epoch value in seconds or
    milliseconds; unparseable values go to ``error_bucket``."""
    return df.withColumn(out, event_day(value_col))


def write_day_partitioned(df: DataFrame, path: str, value_col: str, max_records: int = 1_000_000,
                          fmt: str = "parquet", mode: str = "append") -> None:
    """K8 sink: rows written under ``day=yyyyMMdd`` folders. Rows are first
    rebalanced by day, so a task writes few files and adaptive execution
    splits a big day (or the error bucket) over several tasks;
    ``maxRecordsPerFile`` rolls files by size."""
    d = with_event_day(df, value_col)
    (d.hint("rebalance", "day").write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records)
       .partitionBy("day").save(path))


def bucket_counts(df: DataFrame, key: str, n: int, overrides: DataFrame | None = None) -> DataFrame:
    """F20 applied: rows per hash bucket of ``key``."""
    b = with_hash_bucket(df.select(key), key, n, "bucket", overrides)
    return b.groupBy("bucket").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def ordered_list(df: DataFrame, key: str, seq: str, val: str, out: str = "items") -> DataFrame:
    """A9 (re-aimed): per key, the values in ``seq`` order as an array --
    the per-key list the original kept by appending. The list is the
    feature, so its size is the group's size; values should be small
    (ids, labels), not documents."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(seq, val))).alias("__l"))
    return g.select(key, F.transform("__l", lambda s: s[val]).alias(out))


def scan_limit(df: DataFrame, key: str, n: int, row_key: str = "row_key") -> DataFrame:
    """The first ``n`` rows by ``key`` (a top-k, so only k rows per task
    move), with a text ``row_key`` column."""
    return df.orderBy(key).limit(n).withColumn(row_key, F.col(key).cast("string"))


def count_rows(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (lazy; parquet answers it from
    file footers)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
