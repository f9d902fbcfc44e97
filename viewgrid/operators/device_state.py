"""The latest row of every device, kept as a bucketed table and merged day by day.

"Latest" over a device's whole history is a maximum, and a maximum of maxima
is the maximum: the state of yesterday and today's rows are enough.  The state is
a Parquet table bucketed by device.  A merge brings the day's candidates (one
row a device, after a partially aggregated ``max_by``) to the state's buckets; the
state is read, joined and written where it lies, so only the day is shuffled.
Merging the same rows again changes nothing.

Each merge writes a new version beside the old one.  The last complete version (it has
a ``_SUCCESS`` mark) is the state, so a merge that fails leaves the state as it was;
older versions than the one before it are removed.

A maximum can't forget: where rows of a loaded date are corrected, ``rebuild`` from the
rows that are left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.operators.topn import last_by

BUCKETS = 64  # files of a version; more for more devices (some 10 million a bucket are fine)


class DeviceState:
    """Latest ``values`` of each ``key`` by ``order`` (columns; the last row in this order counts), under the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: list[str], values: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.order, self.buckets = spark, root.rstrip("/"), key, order, buckets
        self.kept = [*order, *(v for v in values if v not in order)]

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first (two or three: the listing is bounded)."""
        jvm, path, fs = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        done = [n for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS"))]
        return sorted(int(n[1:]) for n in done)

    def _place(self, version: int) -> str:
        return f"{self.root}/v{version}"

    def _name(self) -> str:
        return f"device_state_{uuid.uuid4().hex}"

    def read(self) -> DataFrame | None:
        """(key, order and value columns) of every device, bucketed by device; None before the first merge."""
        have = self.versions()
        if not have:
            return None
        place, name = self._place(have[-1]), self._name()
        schema = self.spark.read.parquet(place).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame, version: int) -> None:
        name = self._name()
        rows.write.bucketBy(self.buckets, self.key).option("path", self._place(version)).format("parquet").mode("overwrite").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        jvm, _, fs = self._fs()
        for old in self.versions()[:-2]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._place(old)), True)

    def latest(self, rows: DataFrame) -> DataFrame:
        """The latest of ``rows`` for each device."""
        return last_by(rows.where(F.col(self.key).isNotNull()), [self.key], self.order, self.kept)

    def merged(self, rows: DataFrame) -> DataFrame:
        """The state with ``rows`` taken in: a full join on the state's buckets."""
        day, state = self.latest(rows), self.read()
        if state is None:
            return day.repartition(self.buckets, self.key)
        new, old = (df.select(F.col(self.key).alias(f"{side}_key"), F.struct(*self.kept).alias(side)) for df, side in ((day, "new"), (state, "old")))
        # the rows come to the state's buckets: with more shuffle partitions than buckets Spark would otherwise move both sides
        both = old.join(new.repartition(self.buckets, "new_key"), F.col("old_key") == F.col("new_key"), "full")
        order = {side: F.struct(*(F.col(side)[c] for c in self.order)) for side in ("old", "new")}
        best = F.when(F.col("old").isNull() | (order["new"] > order["old"]), F.col("new")).otherwise(F.col("old"))
        best = F.when(F.col("new").isNull(), F.col("old")).otherwise(best)
        return both.select(F.coalesce("old_key", "new_key").alias(self.key), best.alias("best")).select(self.key, "best.*")

    def merge(self, rows: DataFrame) -> None:
        """Take ``rows`` (of a day, or any others) into the state."""
        self._write(self.merged(rows), max(self.versions(), default=0) + 1)

    def rebuild(self, rows: DataFrame) -> None:
        """Replace the state by the latest of ``rows``."""
        self._write(self.latest(rows).repartition(self.buckets, self.key), max(self.versions(), default=0) + 1)

    def forget(self, ids: DataFrame) -> None:
        """Remove the devices in the only column of ``ids``, from older versions too."""
        state = self.read()
        if state is None:
            return
        gone = ids.select(F.col(ids.columns[0]).alias("__gone")).distinct()
        version = self.versions()[-1] + 1
        self._write(state.join(gone, F.col(self.key) == F.col("__gone"), "left_anti"), version)
        jvm, _, fs = self._fs()
        for old in self.versions()[:-1]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._place(old)), True)
