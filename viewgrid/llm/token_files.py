"""Token-id files: documents as Simple-8b blocks in ascending doc_id order (operator 3).

``write`` range-partitions the documents by doc_id, encodes them inside the
tasks and writes a Parquet folder whose rows are blocks of whole documents:

    part, block       place of the block; (part, block) ascending is doc_id ascending
    first, n_ids      ids of the part before the block, and in it
    doc_ids, ends     the block's documents and where the ids of each end in the block
    mark_word, mark_id  every 256 words, a word's index and the ids before it, so that
                      one document can be decoded without the words before it
    words             the Simple-8b words, little-endian

Spark's writer commits the files, so a lost task or executor leaves nothing behind.

Defined results: a null or empty text has the end id alone.  Documents without a
doc_id come first.  Rows that repeat a doc_id are all written, by text hash;
a doc_id that holds a large part of all rows is dealt over several parts.
Other columns are ignored.  No rows: an empty folder that reads back as no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewgrid.llm import simple8b
from viewgrid.llm import textscan as ts
from viewgrid.llm.pieces import encoder

BLOCK_IDS = 1 << 16  # a block is closed when it has so many ids
BLOCKS = (
    "part int, block int, first long, n_ids long, doc_ids array<long>, ends array<long>, "
    "mark_word array<long>, mark_id array<long>, words binary"
)


def _blocks(tokenizer: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer).documents
        ids: list[np.ndarray] = []
        docs: list = []
        ends: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            words = simple8b.pack(np.concatenate(ids))
            at, before = simple8b.marks(words)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([held], pa.int64()),
                    pa.array([docs], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                    pa.array([at], pa.list_(pa.int64())), pa.array([before], pa.list_(pa.int64())), pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                ["part", "block", "first", "n_ids", "doc_ids", "ends", "mark_word", "mark_id", "words"],
            )

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, buf, offs in ts.text_chunks(batch.column(1)):
                flat, sizes = encode(buf, offs)
                at = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                for k in range(b - a):
                    ids += [flat[at[k] : at[k + 1]], np.array([end_id], dtype=flat.dtype)]
                    held += at[k + 1] - at[k] + 1
                    docs.append(keys[a + k])
                    ends.append(held)
                    if held >= block_ids:
                        yield close()
                        block, first, held, ids, docs, ends = block + 1, first + held, 0, [], [], []
        if docs:
            yield close()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Write the token-id files of ``docs`` (doc_id, text) to the folder ``path``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(parts, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    rows.select("doc_id", "text").mapInArrow(_blocks(tokenizer, end_id, block_ids), BLOCKS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.to_pylist():
            ids = simple8b.unpack(np.frombuffer(x["words"], "<u8"), x["n_ids"]).astype("<u4")
            ends = np.array(x["ends"], dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["doc_ids"], pa.int64()), pa.array(starts + x["start"]), pa.array(ends - starts), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of all documents before each.

    The running sum goes over one row for each written part; that table is the
    one broadcast, its rows bounded by the number of parts of the write.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("first"))


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    rows = read_blocks(spark, path).select("start", "n_ids", "doc_ids", "ends", "words")
    return rows.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and its ids (the end id last) as an array, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                words = np.frombuffer(x["words"], "<u8")
                at, before, a = np.array(x["mark_word"]), np.array(x["mark_id"]), 0
                for key, b in zip(x["doc_ids"], x["ends"]):
                    ids = simple8b.unpack_slice(words, at, before, a, b - a).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([ids], pa.list_(pa.int64()))], ["doc_id", "ids"])
                    a = b

    rows = spark.read.schema(BLOCKS).parquet(path).select("doc_ids", "ends", "mark_word", "mark_id", "words")
    return rows.mapInArrow(run, "doc_id long, ids array<long>")
