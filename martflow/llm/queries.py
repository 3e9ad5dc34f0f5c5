"""The operators' registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embdup, langid, lmscore, neardup, packing, quality, repair, secrets, sharding, tiling, toxicity, variants
from .common import held_out, prepare, written
from .oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_ppm_score(spark, sf_dir):
    held = held_out("doc_id", 7)
    scored = lmscore.score(table(spark, sf_dir, "documents"), held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_sorted_projection_dedup(spark, sf_dir):
    return embdup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op3_schema_fingerprint_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(probe).alias("text"))
    return chat.digest(chat.format_turns(rows.unionByName(more)))


@query
def op4_subword_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(False))
    found = langid.identify(docs, train)
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_kn_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


@query
def op6_minmax_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query
def op7_trigram_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op8_hypergeometric_shards(spark, sf_dir):
    """Whole documents in shards, written; a digest of what was written."""
    shards = written(sharding.hypergeometric_shards(table(spark, sf_dir, "documents"), 40))
    text = F.coalesce(F.col("text"), F.lit(""))
    return shards.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_string_tiling(spark, sf_dir):
    """The contaminated documents."""
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "text_key").agg(
        F.max("coverage").alias("coverage"), F.array_sort(F.collect_set("item_id")).alias("item_ids")) \
        .select("doc_id", "coverage", "item_ids")


@query
def op10_hilbert_pack(spark, sf_dir):
    """Whole sequences, written; a digest of what was written."""
    return packing.digest(written(packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=True)))


@query
def op11_permuterm_variants(spark, sf_dir):
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark, sf_dir):
    whole = table(spark, sf_dir, "conversations")
    rows = repair.damage(whole)
    audited = written(repair.audits(rows))
    return repair.digest(repair.apply(rows, audited), audited, whole)


@query
def op13_subword_toxicity(spark, sf_dir):
    train = ~held_out("doc_id", 5, 0)
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
