"""Key bucketing (F20): stable hash bucket per key with hot-key overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key, n: int) -> Column:
    """Bucket = (last three hex digits of md5(key as text)) mod n, as ``%04d``.
    Three digits tell 4,096 buckets apart, so ``n`` may not be larger."""
    if not 0 < n <= 4096:
        raise ValueError("between 1 and 4096 buckets")
    tail = F.substring(F.md5(_c(key).cast("string")), 30, 3)
    return F.format_string("%04d", (F.conv(tail, 16, 10).cast("int") % F.lit(n)))


def with_hash_bucket(df: DataFrame, key: str, n: int, out: str = "bucket",
                     overrides: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = hash bucket of ``key``; keys listed in ``overrides``
    (columns ``key_lower``, ``bucket``; a short fixed list of hot keys) get
    their own bucket instead. Lookup is case-insensitive on the key text."""
    b = hash_bucket(key, n)
    if overrides is None:
        return df.withColumn(out, b)
    o = overrides.select(F.col("key_lower").alias("__ok"), F.col("bucket").alias("__ob"))
    return (df.join(o, F.lower(_c(key).cast("string")) == F.col("__ok"), "left")
              .withColumn(out, F.coalesce(F.col("__ob"), b)).drop("__ok", "__ob"))
