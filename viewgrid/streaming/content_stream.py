"""Structured Streaming variant of the daily content load.

Files landing in a directory are the stream; each micro-batch runs the
stateless ``content_detail`` transform and is written under
``<target>/batch_id=<n>`` with overwrite.  A replayed batch (after a failure
between the write and the checkpoint commit) rewrites the same directory, so
the output is exactly-once without relying on a high-water ``MAX()`` guess;
the file source's checkpoint tracks which files were processed, so late
files for old dates are picked up too (the warehouse's ``date > MAX`` rule
would drop them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewgrid.plans import models


def land(feed: DataFrame, path: str) -> None:
    """Append a feed's rows as parquet files to the landing zone (one file
    per input partition; no funnelling through a single task)."""
    feed.write.mode("append").parquet(path)


def run(spark: SparkSession, landing: str, target: str, checkpoint: str, schema,
        genre_map: DataFrame, tz_map: DataFrame, max_files_per_trigger: int = 64) -> None:
    """Process everything currently in ``landing`` and stop (availableNow)."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = models.content_detail(batch, genre_map, tz_map)
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch_id")
