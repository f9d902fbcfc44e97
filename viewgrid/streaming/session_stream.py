"""Connected sessions as a stream: watermark, duplicate removal and session windows with state.

A row is a session window of its own, from its start to its end plus the gap that may
lie between connected sessions; Spark's state store merges the windows of a key that
overlap, across micro-batches and whatever the order in which rows arrive.  A merged
session is written once no row that the watermark still admits can touch it, into
partitions of its date.

Rows may come up to ``delay`` behind the latest start seen so far; later ones are dropped.
A file that is landed twice changes nothing: its rows are known within the watermark and too late
beyond it.  State holds the open sessions and the rows of the last ``delay``, not the
history.  The file sink's log makes the output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.plans.analytics import CONNECT_GAP_SECONDS

KEYS = ("hash", "date_partition", "show_title", "channel_affiliate")


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def connected(stream: DataFrame, delay: str, keys=KEYS, start: str = "ts_start", end: str = "ts_end",
              gap_seconds: int = CONNECT_GAP_SECONDS) -> DataFrame:
    """(keys, island_start, island_end, sessions, total_seconds) of closed sessions; rows without the first key take no part.

    As in ``operators.sessions``, a row that starts exactly ``gap_seconds`` after the latest end
    still belongs to the session: session windows that touch are merged.
    """
    rows = stream.withColumn("__t", F.col(start).cast("timestamp")).withWatermark("__t", delay)
    rows = rows.dropDuplicatesWithinWatermark(stream.columns).where(F.col(keys[0]).isNotNull())
    length = F.greatest(_micros(end) - _micros(start), F.lit(0)) + gap_seconds * 1_000_000
    window = F.session_window("__t", F.make_interval(secs=(length / 1_000_000).cast("decimal(18,6)")))
    g = rows.groupBy(window.alias("__w"), *keys).agg(
        F.min(start).alias("island_start"), F.max(end).alias("island_end"), F.count(F.lit(1)).alias("sessions"),
        F.sum(F.timestamp_diff("SECOND", F.col(start), F.col(end))).alias("total_seconds"))
    return g.select(*keys, "island_start", "island_end", "sessions", "total_seconds")


def heartbeat(spark: SparkSession, schema, ts, start: str = "ts_start") -> DataFrame:
    """A row that holds nothing but a start time: landed after the last rows, it moves the watermark on and closes sessions."""
    return spark.createDataFrame([tuple(ts if f.name == start else None for f in schema)], schema)


def run(spark: SparkSession, landing: str, target: str, checkpoint: str, schema, delay: str, max_files_per_trigger: int = 64) -> None:
    """Take in everything that lies in ``landing`` and stop; open sessions wait in the checkpoint for the next run."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
    q = (connected(stream, delay).writeStream.format("parquet").partitionBy("date_partition").outputMode("append")
         .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
