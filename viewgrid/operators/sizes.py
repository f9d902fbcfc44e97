"""Sizes of the files behind a DataFrame, for choices of layout alone: no result hangs on them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def input_bytes(df: DataFrame, enough: int) -> int:
    """Bytes of the files that ``df`` reads, counted until they reach ``enough``; 0 where no file lies behind it."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for f in df.inputFiles():
        if size >= enough:
            break
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))  # the names are URL-encoded
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    return size
