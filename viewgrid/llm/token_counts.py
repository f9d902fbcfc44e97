"""Exact histogram of encoded lengths and what its suffix sums answer (operator 2).

Documents are encoded in Arrow tasks that return lengths alone; one partially
aggregated shuffle counts them by length.  The histogram has at most as many
rows as the longest document has tokens.  Its suffix sums are taken in two
levels (inside ranges of ``RANGE`` lengths, then over the ranges), so no task
meets the whole histogram.

Defined results: a null or empty text has length 0; repeated rows count each;
other columns are ignored; no rows give an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.pieces import encoder
from viewgrid.session import shared_dir

RANGE = 128


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens of every row of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).documents
        for batch in batches:
            for _, _, buf, offs in ts.text_chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(encode(buf, offs)[1], pa.int64())], ["n_tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens and docs; checkpointed, as its suffix sums read it twice."""
    shared_dir(docs.sparkSession)  # the checkpoint folder
    return lengths(docs, tokenizer).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs")).checkpoint()


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit:

    docs (of that very length), docs_at_least and tokens_at_least (of documents so
    long or longer), docs_up_to (not longer: what the limit leaves whole),
    truncated_tokens (tokens left when every document is cut to the limit),
    total_docs and total_tokens (of the corpus).
    """
    h = hist.withColumns({"tokens": F.col("n_tokens") * F.col("docs"), "range": F.floor(F.col("n_tokens") / RANGE)})
    ranges = h.groupBy("range").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(ranges, "range").withColumns(
        {
            "docs_at_least": F.col("docs_above") + F.sum("docs").over(inside),
            "tokens_at_least": F.col("tokens_above") + F.sum("tokens").over(inside),
        }
    )
    return out.select(
        "n_tokens", "docs", "docs_at_least", "tokens_at_least",
        (F.col("total_docs") - F.col("docs_at_least") + F.col("docs")).alias("docs_up_to"),
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        "total_docs", "total_tokens",
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit and truncated_tokens for any limits, whether a document has that length or not."""
    longer = F.struct("n_tokens", "docs_at_least", "tokens_at_least")
    cut = [
        F.coalesce(
            F.max("total_tokens") - F.min(F.when(F.col("n_tokens") >= x, longer)).tokens_at_least + x * F.min(F.when(F.col("n_tokens") >= x, longer)).docs_at_least,
            F.max("total_tokens"),
            F.lit(0),
        )
        for x in limits
    ]
    rows = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit"), c.cast("long").alias("truncated_tokens")) for x, c in zip(limits, cut)])
    return sums.agg(rows.alias("rows")).select(F.inline("rows"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share and the least length that so large a share of the documents doesn't exceed (none without documents)."""
    found = [F.min(F.when(F.col("docs_up_to") >= F.greatest(F.lit(1), F.ceil(F.col("total_docs") * s)), F.col("n_tokens"))) for s in shares]
    rows = F.array(*[F.struct(F.lit(float(s)).alias("share"), c.alias("n_tokens")) for s, c in zip(shares, found)])
    return sums.agg(rows.alias("rows")).select(F.inline("rows"))
