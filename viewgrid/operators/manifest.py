"""Which dates of a feed differ from what was loaded.

A date's fingerprint is its number of rows and two sums of row hashes.  Sums don't
depend on the order of rows or on how they are dealt over files, and they are partially
aggregated, so a feed is fingerprinted in one scan that shuffles a row per date and
task.  The fingerprints of a run are kept beside its table; the next run
reloads the dates whose fingerprint is another: late rows, corrected rows, removed rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.operators.incremental import Window

FINGERPRINT = "date date, n long, one decimal(38,0), two decimal(38,0)"


def fingerprints(feed: DataFrame, date: str | Column) -> DataFrame:
    """(date, n, one, two) of every date of ``feed``, over all its columns."""
    columns = [F.col(f"`{c}`") for c in feed.columns]
    day = F.col(date) if isinstance(date, str) else date
    rows = feed.select(day.cast("date").alias("date"), F.xxhash64(*columns).alias("one"), F.xxhash64(F.lit(1), *columns).alias("two"))
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)").alias(c) for c in ("one", "two")]
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"), *sums)


def changed(now: DataFrame, before: DataFrame) -> tuple[dt.date, ...]:
    """Dates whose rows differ between two sets of fingerprints, also those that only one has; a value per day reaches the driver."""
    rows = now.withColumn("side", F.lit(1)).unionByName(before.withColumn("side", F.lit(2)))
    g = rows.where("date is not null").groupBy("date").agg(F.count(F.lit(1)).alias("sides"), F.countDistinct("n", "one", "two").alias("kinds"))
    return tuple(sorted(r.date for r in g.where("sides <> 2 or kinds <> 1").select("date").collect()))


class Manifest:
    """Fingerprints of the loaded dates, under ``path``; a new set is written beside the old one and then takes its place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _runs(self) -> list[int]:
        jvm, root, fs = self._hadoop()
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame:
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], FINGERPRINT)
        return self.spark.read.schema(FINGERPRINT).parquet(f"{self.path}/{runs[-1]}")

    def window(self, now: DataFrame) -> Window:
        """The dates that a run has to reload, given the fingerprints of the feed."""
        return Window(dates=changed(now, self.read()))

    def record(self, now: DataFrame) -> None:
        """Keep the fingerprints, once the table holds the rows behind them; a run that fails before that reloads the same dates."""
        runs = self._runs()
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{max(runs, default=0) + 1}")
        jvm, _, fs = self._hadoop()
        for old in runs[:-1]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{old}"), True)
