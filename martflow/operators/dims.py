"""Dimension lookups.

A lookup is a join; how it runs is left to Catalyst and adaptive execution,
which know the sides' bytes. Only lists written out in the code (the
dictionary) come with a broadcast hint, given where the list is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import versions
from .cdc import change_order, flatten_dict, image, select_changes


def dict_lookup(df: DataFrame, dic: DataFrame, key: str, out: str, how: str = "inner",
                code_col: str = "dic_code", name_col: str = "dic_name") -> DataFrame:
    """Lookup of a code in the dictionary (``FOR SYSTEM_TIME AS OF
    proc_time``): adds ``out`` = the code's name. Inner drops unknown codes.
    Join it twice under different ``out`` names for two codes."""
    d = dic
    if "info" in d.columns:
        d = flatten_dict(d)
    d = d.select(F.col(code_col).alias("__code"), F.col(name_col).alias(out))
    return df.join(d, F.col(key) == F.col("__code"), how).drop("__code")


def dict_versions(feed: DataFrame, code: str, out: str, span_ms: int = versions.DAY_MS, table: str = "base_dic") -> DataFrame:
    """S10 with a life of its own: the dictionary's change feed (snapshot rows,
    inserts, updates, deletes) as a validity table (``code``, ``out``,
    valid_from, valid_to) for ``versions.as_of_join``. A delete leaves its code
    unknown until it is inserted again."""
    d = select_changes(feed, table, ("r", "c", "u", "d"))
    rows = d.select(image()["dic_code"].alias(code), image()["dic_name"].alias(out), (F.col("op") == "d").alias("__del"), *change_order(d))
    return versions.versions(rows, code, change_order(d), deleted=F.col("__del"), span_ms=span_ms).drop("__del", "pos")


def with_province(df: DataFrame, provinces: DataFrame, key: str = "province_id") -> DataFrame:
    """Province name by id; a missing province gives a null name (Q14:
    the original failed the job)."""
    p = provinces.select(F.col("id").alias("__pid"), F.col("name").alias("province_name"))
    return df.join(p, F.col(key) == F.col("__pid"), "left").drop("__pid")


def wide_sku_dim(dims: dict[str, DataFrame]) -> DataFrame:
    """Resolve the snowflake sku -> spu, trademark, category3 -> 2 -> 1
    once, as one wide SKU dimension (left joins: a missing link leaves its
    names null instead of failing)."""
    sku = dims["sku"].alias("sku")
    spu = dims["spu"].select(F.col("id").alias("spu_id"), "spu_name")
    tm = dims["trademark"].select(F.col("id").alias("tm_id"), "tm_name")
    c3 = dims["category3"].select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                                  "category2_id")
    c2 = dims["category2"].select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"),
                                  "category1_id")
    c1 = dims["category1"].select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    w = (sku.join(spu, "spu_id", "left").join(tm, "tm_id", "left")
            .join(c3, "category3_id", "left").join(c2, "category2_id", "left")
            .join(c1, "category1_id", "left"))
    return w.select(F.col("id").alias("sku_id"), "sku_name", "spu_id", "spu_name", "tm_id", "tm_name",
                    "category3_id", "category3_name", "category2_id", "category2_name",
                    "category1_id", "category1_name")


def with_sku(df: DataFrame, wide: DataFrame, key: str = "sku_id") -> DataFrame:
    """J7 applied: one left join of (already aggregated) rows to the wide
    SKU dimension."""
    w = wide.withColumnRenamed("sku_id", "__sku")
    return df.join(w, F.col(key) == F.col("__sku"), "left").drop("__sku")
