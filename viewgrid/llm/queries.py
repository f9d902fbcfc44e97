"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.llm import (
    chunk_bpe,
    contamination,
    fingerprints,
    hard_negatives,
    importance,
    near_dedup,
    quality_model,
    quality_rules,
    sharding,
    substring,
    token_counts,
    token_files,
    toxicity,
)
from viewgrid.llm.tables import fold
from viewgrid.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
SHARDS = [f"shard-{k:02d}" for k in range(64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.suffix_sums(token_counts.histogram(docs, public_tokenizers.path(TOKENIZER)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op3-token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_files.read_digest(spark, path)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def _judged(scores: DataFrame, held_out, threshold: float) -> DataFrame:
    held = F.coalesce(held_out, F.lit(True))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    return _judged(toxicity.scored(docs, toxicity.fit(docs, labels, ~held_out)), held_out, toxicity.THRESHOLD)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    return _judged(quality_model.scored(docs, quality_model.fit(docs, labels, ~held_out)), held_out, quality_model.THRESHOLD)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("ratio")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.beside_next(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_token_counts,
        op3_token_files,
        op4_substring,
        op5_toxicity,
        op6_quality_model,
        op7_near_dedup,
        op8_contamination,
        op9_chunk_bpe,
        op10_quality_rules,
        op11_hard_negatives,
        op12_importance,
        op13_fingerprints,
    )
}
ORACLES = {
    "op1_sharding": sharding.placement_sql("documents", "doc_id", SHARDS),
    "op11_hard_negatives": hard_negatives.mined_sql("embeddings", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END", "vec_id % 100 = 0"),
    "op12_importance": importance.resampled_sql("documents", "benchmark"),
}
