"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and lost executors lose nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text (string) alone, whatever else ``docs`` holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Rows of ids in a broadcast table at most (measured: some 60 bytes each, so 12 MB); more are joined by shuffle.
MOST_BROADCAST_IDS = 200_000


def bounded(ids: DataFrame) -> DataFrame:
    """``ids``, rows of one to three numbers that are cheap to count, to be broadcast behind a check of their size."""
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST_IDS else ids


def with_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose doc_id is (``left_semi``) or isn't (``left_anti``) among the distinct doc_ids of ``ids``."""
    return df.join(bounded(ids), "doc_id", how).select(*df.columns)


def fold(of: str, folds: int) -> Column:
    """crc32(doc_id as text) modulo ``folds``; null without doc_id."""
    return F.pmod(F.crc32(F.col(of).cast("long").cast("string").cast("binary")), F.lit(folds))


def labelled_sample(labels: DataFrame, column: str, allowed: Column, bound: int) -> DataFrame:
    """doc_id and label (0 or 1) of at most ``bound`` labelled documents, chosen by a hash of doc_id.

    Rows with another or no label, or without doc_id, are left out; of labels that
    contradict each other the larger counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & allowed)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    # the task that sorts gets the rows of the first hash ranges that hold ``bound`` rows, not ``bound`` of each partition
    part = F.shiftright(F.xxhash64("doc_id"), 48)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # 65,536 ranges at most
    last, total = None, 0
    for r in sorted(counts, key=lambda r: r.part):
        last, total = r.part, total + r.n
        if total >= bound:
            break
    if last is not None:
        rows = rows.where(part <= last)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, label and text of the documents in ``sample`` (``labelled_sample``): one row for each doc_id.

    Of rows that repeat a doc_id the text with the smallest hash counts, so that
    the bound of the sample holds for the rows as well.
    """
    rows = id_and_text(docs).join(F.broadcast(sample), "doc_id")  # broadcast: ``sample`` is bounded
    text = F.struct(F.xxhash64("text").alias("hash"), "text")
    return rows.groupBy("doc_id", "label").agg(F.min(text)["text"].alias("text"))
