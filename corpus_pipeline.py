"""Corpus pipeline: documents to packed training sequences.

``STAGES`` in order: reject low-quality documents, keep one document of each
near-duplicate group, drop documents that hold benchmark items, mask secrets,
pack token sequences. A stage takes (spark, docs, sf_dir) and works on all that
its predecessor kept; all but the last return the columns of documents. Near
duplicates are dropped by row (id and text): an id that has several texts loses
only those that are copies, and of a group's rows of null ids one stays (beside
the row with an id, if there is one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import neardup, packing, quality, secrets, tiling
from martflow.llm.common import prepare, written
from martflow.llm.queries import TOKENIZER, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, and one of its rows of null ids; of repeated rows one."""
    prepare(spark)
    return neardup.one_per_group(docs.select(COLUMNS), shingle=5)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tiling.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span masked, n_chars of changed texts renewed; no document goes."""
    prepare(spark)
    masked = secrets.redact(docs.withColumn("before", F.xxhash64("text")))
    changed = F.xxhash64("text") != F.col("before")
    return masked.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_per_group),
    ("benchmark", no_benchmark),
    ("secrets", no_secrets),
    ("packing", packed),
]

# Perplexities, hashed signatures and token ids have no SQL form; the stages
# are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
