"""Gaps-and-islands and next-row lookups that survive a hot key.

The textbook form -- ``lag``/running ``max`` over ``PARTITION BY key ORDER BY
ts`` -- sends every row of a key to one task.  With one device holding a
third of all rows that task is the whole job.  Here the ordered scan is
split in two levels:

1. rows are cut into time buckets (``date_trunc(unit, start)``); the window
   runs per (key, bucket), so a hot key spreads over many tasks;
2. the only cross-bucket information a row needs (the running max end /
   island count of all earlier buckets, or the first row of the next bucket)
   comes from a per-(key, bucket) summary table -- one row per bucket -- whose
   own window per key is over at most (time span / bucket) rows.

Row order inside a key is (start, end); bucketing on ``start`` preserves it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNBOUNDED = Window.unboundedPreceding


def join_back(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """rows INNER JOIN summary on ``keys`` with NULL-safe equality (a NULL
    network or title is a group of its own, as in PARTITION BY)."""
    r = summary.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                       *[c for c in summary.columns if c not in keys])
    cond = None
    for k in keys:
        e = rows[k].eqNullSafe(r[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return rows.join(r, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def _local_pass(df: DataFrame, keys: list[str], start: str, end: str, gap_seconds: int, bucket: str):
    """Rows with ``__bucket``, ``__local_no`` (islands opened so far inside
    the bucket, 0 = continues an island from an earlier bucket) and
    ``__new`` (row opens an island).  Row data is read twice: once for the
    per-bucket max end (partially aggregated map-side), once for the window
    pass partitioned by (key, bucket)."""
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    b = "__bucket"
    d = df.withColumn(b, F.date_trunc(bucket, F.col(start)))
    kb = keys + [b]
    per_bucket = d.groupBy(*kb).agg(F.max(end).alias("__bmax"))
    wk = Window.partitionBy(*keys).orderBy(b)
    carry = per_bucket.withColumn("__carry_max", F.max("__bmax").over(wk.rowsBetween(UNBOUNDED, -1)))
    d = join_back(d, carry.drop("__bmax"), kb)
    wb = Window.partitionBy(*kb).orderBy(start, end)
    prev_end = F.greatest(F.max(end).over(wb.rowsBetween(UNBOUNDED, -1)), F.col("__carry_max"))
    d = d.withColumn("__new", F.when(prev_end.isNull() | (F.col(start) > prev_end + gap), 1).otherwise(0))
    return d.withColumn("__local_no", F.sum("__new").over(wb.rowsBetween(UNBOUNDED, 0))), kb, wk


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where one windowed result feeds two consumers (a per-bucket count
    and the join back): without the cut, the sort + window would run once per
    consumer.  The checkpoint also ends the lineage, so a lost executor does
    not recompute the upstream ordered pass.
    """
    from viewgrid.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _island_numbers(pieces: DataFrame, keys: list[str], kb: list[str], wk) -> DataFrame:
    """Add ``island_no`` to per-(key, bucket, local_no) pieces: islands opened
    in earlier buckets (a window over one row per bucket) + local number."""
    opened = pieces.groupBy(*kb).agg(F.max("__local_no").alias("__bnew"))
    carry_n = opened.withColumn(
        "__carry_n", F.coalesce(F.sum("__bnew").over(wk.rowsBetween(UNBOUNDED, -1)), F.lit(0)))
    out = join_back(pieces, carry_n.drop("__bnew"), kb)
    return out.withColumn("island_no", F.col("__carry_n") + F.col("__local_no")).drop("__carry_n")


def islands(df: DataFrame, keys: list[str], start: str, end: str, gap_seconds: int,
            bucket: str = "hour") -> DataFrame:
    """Add ``island_no`` (1, 2, ... per key in time order) to every row.

    A row opens a new island when no earlier row of its key exists or its
    start is more than ``gap_seconds`` after the running maximum end of all
    earlier rows (a gap of exactly ``gap_seconds`` stays connected).
    """
    d, kb, wk = _local_pass(df, keys, start, end, gap_seconds, bucket)
    d = _cut(d)
    counts = d.groupBy(*kb, "__local_no").agg(F.count(F.lit(1)).alias("__n"))
    nums = _island_numbers(counts, keys, kb, wk).drop("__n")
    out = join_back(d, nums, kb + ["__local_no"])
    return out.drop("__bucket", "__carry_max", "__new", "__local_no")


def island_summary(df: DataFrame, keys: list[str], start: str, end: str, gap_seconds: int,
                   seconds: Column | None = None, bucket: str = "hour",
                   piece_aggs: list[Column] | None = None, merge_aggs: list[Column] | None = None) -> DataFrame:
    """One row per island: start, end, row count, summed seconds.

    Rows are folded into pieces -- one per (key, bucket, local island) -- in
    the same partitioning as the window pass (no extra shuffle of row data);
    pieces are numbered and merged per island.  Extra measures are given as
    a piece-level aggregate plus the aggregate that merges pieces (e.g. a
    per-piece ``collect_set`` merged by union and ``size``).
    """
    secs = seconds if seconds is not None else F.timestamp_diff("SECOND", F.col(start), F.col(end))
    d, kb, wk = _local_pass(df, keys, start, end, gap_seconds, bucket)
    pieces = d.withColumn("__secs", secs).groupBy(*kb, "__local_no").agg(
        F.min(start).alias("__s"), F.max(end).alias("__e"), F.count(F.lit(1)).alias("__n"),
        F.sum("__secs").alias("__sum"), *(piece_aggs or []))
    nums = _island_numbers(_cut(pieces), keys, kb, wk)
    return nums.groupBy(*keys, "island_no").agg(
        F.min("__s").alias("island_start"), F.max("__e").alias("island_end"),
        F.sum("__n").alias("sessions"), F.sum("__sum").alias("total_seconds"), *(merge_aggs or []))


def with_next(df: DataFrame, keys: list[str], start: str, order: list[str], values: list[str],
              bucket: str = "hour", prefix: str = "next_") -> DataFrame:
    """Add ``next_<v>`` = value of the following row of the same key.

    Ordered by ``order`` (whose first column is ``start``).  Inside a bucket
    ``lead`` finds it; the last row of a bucket takes the first row of the
    key's next non-empty bucket, found from a one-row-per-bucket table.
    """
    b = "__bucket"
    d = df.withColumn(b, F.date_trunc(bucket, F.col(start)))
    kb = keys + [b]
    firsts = d.groupBy(*kb).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("__first"))
    wk = Window.partitionBy(*keys).orderBy(b)
    nxt = firsts.select(*kb, F.lead("__first").over(wk).alias("__next_bucket_first"))
    d = join_back(d, nxt, kb)
    wb = Window.partitionBy(*kb).orderBy(*order)
    last_in_bucket = F.lead(F.lit(True)).over(wb).isNull()
    for v in values:
        d = d.withColumn(prefix + v, F.when(last_in_bucket, F.col(f"__next_bucket_first.{v}"))
                         .otherwise(F.lead(v).over(wb)))
    return d.drop(b, "__next_bucket_first")
