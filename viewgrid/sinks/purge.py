"""Removal of devices from built tables, file by file.

An opt-out concerns few devices and few files.  The files that hold one of them are found by
a scan of the id column alone; the rows of these files that stay are written beside the
table, partition by partition and without a shuffle, then the old files go and the new ones
take their places.  All other files keep their names and times.

The list of old files is written last and is the commit: a purge that stops before it has
changed nothing and starts over, one that stops after it is finished by the next
call.  Readers may miss rows of the rewritten files while files are being exchanged.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.operators.enrich import bounded_broadcast

WORK = "_purge"  # readers skip folders with an underscore
FILE_BYTES = 128 << 20  # of old files for one task
THREADS = 4  # partitions rewritten at a time


class _Files:
    """The table's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def drop(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def length(self, path: str) -> int:
        return self.fs.getFileStatus(self.at(path)).getLen()

    def data_files(self, root: str) -> list[str]:
        """Relative paths of the Parquet files under ``root``."""
        top, out = self.fs.makeQualified(self.at(root)).toString(), []
        found = self.fs.listFiles(self.at(root), True)
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(".parquet"):
                out.append(name[len(top):].lstrip("/"))
        return out

    def move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.at(new).getParent())
        if not self.fs.rename(self.at(old), self.at(new)):
            raise OSError(f"{old} could not be moved to {new}")


def finish(spark: SparkSession, path: str) -> None:
    """End a purge of the table at ``path`` that stopped half-way."""
    files, work = _Files(spark, path), f"{path.rstrip('/')}/{WORK}"
    if files.exists(f"{work}/old/_SUCCESS"):
        for r in spark.read.text(f"{work}/old").collect():  # the files that are rewritten
            files.drop(r.value)
        for name in files.data_files(f"{work}/rows"):
            files.move(f"{work}/rows/{name}", f"{path.rstrip('/')}/{name}")
    files.drop(work)


def purge(spark: SparkSession, path: str, ids: DataFrame, id_col: str, partition_by=()) -> int:
    """Remove the rows of the table at ``path`` whose ``id_col`` is in the only column of ``ids``; the number of files rewritten."""
    path = path.rstrip("/")
    finish(spark, path)
    files, work = _Files(spark, path), f"{path}/{WORK}"
    ids.select(F.col(ids.columns[0]).alias("__gone")).distinct().write.parquet(f"{work}/ids")  # every partition reads them
    gone = bounded_broadcast(spark.read.parquet(f"{work}/ids"))  # few: the table's rows aren't shuffled for them
    rows = spark.read.parquet(path).select(F.col(id_col).alias("__id"), F.col("_metadata.file_path").alias("file"))
    hit = rows.join(gone, F.col("__id") == F.col("__gone"), "left_semi").select("file").distinct()
    old = [r.file for r in hit.collect()]  # names of files, at most those of the table
    if not old:
        files.drop(work)
        return 0
    folders = defaultdict(list)  # of one partition each, relative to the table
    for f in old:
        folders["/".join(f.split("/")[-1 - len(partition_by):-1]) if partition_by else ""].append(f)

    def rewrite(folder: str) -> None:
        """Files are read and written by the same tasks: they keep their order, and no more files come than there were or tasks need."""
        some = folders[folder]
        kept = spark.read.option("basePath", path).parquet(*some)
        kept = kept.join(gone, kept[id_col] == gone["__gone"], "left_anti").drop(*partition_by)
        tasks = sum(-(-files.length(f) // FILE_BYTES) for f in some)
        kept.coalesce(tasks).write.parquet(f"{work}/rows/{folder}")

    with ThreadPoolExecutor(max_workers=THREADS) as pool:
        list(pool.map(rewrite, folders))
    spark.createDataFrame([(f,) for f in old], "value string").coalesce(1).write.text(f"{work}/old")
    finish(spark, path)
    return len(old)
