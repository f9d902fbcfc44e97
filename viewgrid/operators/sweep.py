"""Time spent and rows under way per time bucket, by a sweep.

A session that lasts for hours belongs to every hour it covers.  Cutting it into
a row per bucket grows with its length; here it becomes two events, whatever
its length: its seconds in the buckets where it begins and ends, and +1 / -1
where the run of buckets that it covers whole begins and ends.  Events are added up
per bucket (partial aggregation, so a hot bucket is combined map-side); a running
sum over the buckets, one row each, gives the number of sessions that cover a
bucket.  That table is bounded by the time span, not by the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a UTC wall-clock timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def bucket_start(bucket: Column, size: int) -> Column:
    """UTC wall-clock time at which a bucket begins."""
    return F.timestamp_add("SECOND", bucket * F.lit(size), F.lit(EPOCH).cast("timestamp_ntz"))


def _filled(events: DataFrame, by: list[str], step: str, extras: list[str]) -> DataFrame:
    """A row for every bucket with something in it: ``step`` as a running sum, ``extras`` in the event's bucket alone."""
    own = Window.partitionBy(*by).orderBy("bucket")
    running = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = events.select(*by, "bucket", F.lead("bucket").over(own).alias("__next"), F.sum(step).over(running).alias(step), *extras)
    last = F.when(F.col(step) > 0, F.col("__next") - 1).otherwise(F.col("bucket"))
    rows = rows.withColumn("__at", F.explode(F.sequence("bucket", F.greatest("bucket", F.coalesce(last, F.col("bucket"))))))
    here = F.col("__at") == F.col("bucket")
    return rows.select(*by, F.col("__at").alias("bucket"), step, *(F.when(here, F.col(c)).otherwise(0).alias(c) for c in extras))


def seconds_per_bucket(df: DataFrame, start: str, seconds: str, by: list[str], size: int) -> DataFrame:
    """(by, bucket, seconds): the seconds of all rows that fall into each bucket of ``size`` seconds since 1970.

    A row covers ``seconds`` whole seconds from ``start`` (a UTC wall-clock time, cut to the
    second); the seconds of all buckets add up to those of all rows.
    """
    a = epoch_seconds(start)
    first, last = F.floor(a / size).cast("long"), F.floor((a + F.col(seconds)) / size).cast("long")
    d = df.where(F.col(start).isNotNull() & (F.col(seconds) > 0)).select(*by, a.alias("__a"), F.col(seconds).cast("long").alias("__n"), first.alias("__i"), last.alias("__j"))

    def event(bucket: Column, cover, part) -> Column:
        return F.struct(bucket.alias("bucket"), F.lit(cover).cast("long").alias("cover"), part.cast("long").alias("part"))

    i, j, a, n = (F.col(c) for c in ("__i", "__j", "__a", "__n"))
    zero = F.lit(0)
    several = F.array(event(i, 0, (i + 1) * size - a), event(i + 1, 1, zero), event(j, -1, a + n - j * size))
    events = d.select(*by, F.inline(F.when(i == j, F.array(event(i, 0, n))).otherwise(several)))
    events = events.groupBy(*by, "bucket").agg(F.sum("cover").alias("cover"), F.sum("part").alias("part"))
    filled = _filled(events, by, "cover", ["part"])
    return filled.select(*by, "bucket", (F.col("cover") * size + F.col("part")).alias("seconds")).where("seconds > 0")


def under_way(df: DataFrame, start: str, seconds: str, by: list[str], size: int) -> DataFrame:
    """(by, bucket, rows): how many rows are under way (start <= t < end) at the time at which each bucket begins."""
    a = epoch_seconds(start)
    begin, end = F.ceil(a / size).cast("long"), F.ceil((a + F.col(seconds)) / size).cast("long")
    d = df.where(F.col(start).isNotNull() & (F.col(seconds) > 0)).select(*by, begin.alias("__i"), end.alias("__j")).where("__i < __j")
    pair = F.array(*(F.struct(F.col(c).alias("bucket"), F.lit(step).cast("long").alias("rows")) for c, step in (("__i", 1), ("__j", -1))))
    events = d.select(*by, F.inline(pair)).groupBy(*by, "bucket").agg(F.sum("rows").alias("rows"))
    return _filled(events, by, "rows", []).where("rows > 0")


def buckets_touched(start: str, seconds: str, size: int, most: int) -> Column:
    """The buckets that a row has seconds in, its first ``most`` of them: an array."""
    a = epoch_seconds(start)
    first, last = F.floor(a / size), F.floor((a + F.col(seconds) - 1) / size)
    return F.sequence(first, F.greatest(first, F.least(last, first + (most - 1))))
