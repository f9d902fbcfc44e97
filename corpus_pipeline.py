"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, benchmark leaks, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last keep the columns of documents.  ``run``
writes each result to the shared folder as Parquet and reads it back for the
next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.llm import chunk_bpe, contamination, near_dedup, substring, toxicity
from viewgrid.llm.tables import staged

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; learned from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.not_toxic(docs, toxicity.fit(docs, labels, F.lit(True)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group (5-word shingles, similarity 0.8)."""
    return near_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur earlier in the corpus."""
    return substring.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and digests of the ids and of the text decoded from them."""
    return chunk_bpe.digest(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring", cut_repeats),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
