"""Table writers: full rebuild, append, partition replace, keyed upsert.

Storage is Parquet partitioned by date (Delta is not on the classpath; with
Delta, ``upsert`` would be ``MERGE INTO``).  Every write is a single Spark
job; the only driver-side values are paths and option strings.

Clustering (the reference's ``CLUSTER BY (date, id)`` post-hook) becomes a
range repartition on the cluster columns plus a deterministic hash tiebreaker
and a sort within partitions: each file then covers a narrow (date, id)
range, so row-group min/max statistics prune reads by date and device, and
the hash tiebreaker lets a hot (date, id) spread over several files/tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from viewgrid.operators.enrich import bounded_broadcast
from viewgrid.operators.sizes import input_bytes
from viewgrid.session import scratch_path

# model -> (partition columns, cluster columns), from the models' configs
MODEL_LAYOUT = {
    "content_detail": ((), ("VIEWED_DATE", "AKKIO_ID")),
    "content_summary": ((), ("VIEWED_DATE", "AKKIO_ID")),
    "commercial_detail": (("PARTITION_DATE",), ("AKKIO_ID",)),
    "commercial_summary": (("PARTITION_DATE",), ("AKKIO_ID",)),
    "standard_detail": ((), ("ACTIVITY_DATE", "AKKIO_ID")),
    "standard_summary": ((), ()),
    "attributes_latest": ((), ("PARTITION_DATE", "TV_ID")),
    "agg_hh": ((), ("PARTITION_DATE", "AKKIO_HH_ID")),
    "agg_ind": ((), ("PARTITION_DATE", "AKKIO_ID")),
    "agg_media": ((), ("PARTITION_DATE", "AKKIO_ID")),
    "campaign_nbc": ((), ("IMPRESSION_DATE", "AKKIO_ID")),
    "campaign_fbfs": ((), ("IMPRESSION_DATE", "AKKIO_ID")),
    "reach_by_title": (("PARTITION_DATE",), ("TITLE",)),
    "reach_by_brand": (("PARTITION_DATE",), ("BRAND_NAME",)),
}


MODEL_COMMENTS = {
    "content_detail": "One row per device viewing session",
    "content_summary": "One row per device and day of viewing",
    "commercial_detail": "One row per ad exposure",
    "commercial_summary": "One row per device and day of ad exposure",
    "standard_detail": "One row per device and day of activity",
    "standard_summary": "Active devices per day and market",
    "attributes_latest": "One row per device: decoded demographics and latest location",
    "agg_hh": "One row per household",
    "agg_ind": "One row per individual",
    "agg_media": "Viewing counts per device and day, by category",
    "campaign_nbc": "Impressions of the first campaign",
    "campaign_fbfs": "Impressions of the second campaign",
    "reach_by_title": "Sketch of the devices that watched a title on a day",
    "reach_by_brand": "Sketch of the devices that saw a brand's ads on a day",
}

COLUMN_COMMENTS = {
    "PARTITION_DATE": "Date of the source partition, or of the snapshot",
    "AKKIO_ID": "Device id",
    "AKKIO_HH_ID": "Household id (equal to the device id today)",
    "HH_WEIGHT": "Household weight, fixed at 1",
    "INCOME": "Household income in dollars (lower bound of the bracket)",
    "TOTAL_SECONDS": "Length in seconds",
    "TIMEZONE": "Time zone of the device",
    "DBT_UPDATED_AT": "When the run wrote the row",
    "DEVICES": "HyperLogLog sketch of distinct devices; merge with hll_union_agg",
    "VIEWS": "Rows behind the sketch",
}


#: Columns that are looked up by value: date order alone can't tell which row groups hold an id.
BLOOM_COLUMNS = ("AKKIO_ID", "AKKIO_HH_ID")
BLOOM_BYTES = 1 << 20  # of a column in a row group at most; the writer takes the smallest size that fits its ids


def with_bloom_filters(w: DataFrameWriter, columns) -> DataFrameWriter:
    """``w`` with Parquet Bloom filters on the id columns among ``columns``.

    An equality or IN on an id then skips the row groups whose filter rules it out, also
    where ids are too many for a dictionary.
    """
    ids = [c for c in BLOOM_COLUMNS if c in columns]
    for c in ids:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if ids:
        w = w.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", BLOOM_BYTES)
    return w


def ranged(df: DataFrame, cluster_by, num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``cluster_by`` (with a hash tiebreaker)."""
    cols = [F.col(c) for c in cluster_by]
    # deterministic tiebreaker over the hashable columns (maps cannot be hashed)
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    tiebreak = F.xxhash64(*[F.col(c) for c in hashable])
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols, tiebreak)


def clustered(df: DataFrame, cluster_by, num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort on ``cluster_by`` (with a hash tiebreaker)."""
    return ranged(df, cluster_by, num_partitions).sortWithinPartitions(*cluster_by)


#: Input files' bytes for one more bucket of a date in the shuffle before a write by dates, and the most buckets.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 16


def buckets(df: DataFrame) -> int:
    """Into how many parts the rows of a date are dealt before a write by dates; from the sizes of the files behind ``df``."""
    return min(MAX_BUCKETS, 1 + input_bytes(df, BUCKET_BYTES * MAX_BUCKETS) // BUCKET_BYTES)


def rebalanced(df: DataFrame, partition_by, cluster_by=()) -> DataFrame:
    """``df`` dealt out by ``partition_by`` for a write in such partitions.

    REBALANCE: AQE sizes the write partitions evenly and splits a hot date over several
    tasks/files.  It can't split what one task before the shuffle wrote for a partition, so
    dates of large inputs are dealt in buckets by their ids (rows without: by a hash of the row), over more partitions.
    """
    k = buckets(df)
    if k == 1:
        return df.hint("rebalance", *partition_by)
    n = k * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [c for c in (*cluster_by, *BLOOM_COLUMNS) if c in df.columns and c not in partition_by]  # one id's rows compress well together
    by = by or [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]  # maps cannot be hashed
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*by), F.lit(k)))
    return dealt.hint("rebalance", n, *partition_by, "__bucket").drop("__bucket")


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as schema metadata (persisted in Parquet); names that ``df`` lacks are ignored."""
    for c, text in comments.items():
        if c in df.columns:
            meta = dict(df.schema[c].metadata)
            meta["comment"] = text
            df = df.withMetadata(c, meta)
    return df


def described(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared comments of model ``name``; the model's own comment is kept on its first column
    that is never a partition (a partition's metadata isn't stored)."""
    df = with_comments(df, COLUMN_COMMENTS)
    first = next(c for c in df.columns if c != "PARTITION_DATE")
    return df.withMetadata(first, {**df.schema[first].metadata, "table_comment": MODEL_COMMENTS.get(name, name)})


def table_comment(df: DataFrame) -> str | None:
    """The model comment of a table written by ``write_model``."""
    return next((f.metadata["table_comment"] for f in df.schema if "table_comment" in f.metadata), None)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(), cluster_by=(),
                dynamic: bool = False, comments: dict[str, str] | None = None, watch: tuple[Observation, list] | None = None) -> None:
    """Write ``df`` as Parquet.

    ``watch`` is an observation and the aggregates of the written rows that it is to hold.
    They are taken behind the last shuffle, in the tasks that write: stages before it may run
    again (range partitioning samples its input, lost shuffle files are made anew) and would count twice.
    ``dynamic=True`` with ``mode='overwrite'`` replaces only the partitions
    present in ``df`` (idempotent back-fill of a date window).
    """
    if comments:
        df = with_comments(df, comments)
    if partition_by:
        # the sort stands behind it, so every file is in order inside its dates
        df = rebalanced(df, partition_by, cluster_by)
    elif cluster_by:
        df = ranged(df, cluster_by)
    if watch and watch[1]:
        df = df.observe(watch[0], *watch[1])
    if partition_by or cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    w = with_bloom_filters(df.write.mode(mode), df.columns)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_model(df: DataFrame, path: str, name: str, mode: str = "overwrite", watch=None) -> None:
    part, clus = MODEL_LAYOUT.get(name, ((), ()))
    write_table(described(df, name), path, mode=mode, partition_by=part, cluster_by=clus, watch=watch)


def read_table(spark, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a written table; with ``like``, use its schema and column order
    (partition columns otherwise come back last and type-inferred)."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def append(df: DataFrame, path: str, partition_by=()) -> None:
    write_table(df, path, mode="append", partition_by=partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by=("PARTITION_DATE",), cluster_by=(), window=None) -> None:
    """Overwrite the partitions present in ``df``; others stay.

    With a ``window`` of given dates every date of it is replaced: partitions of dates
    that no longer have rows are removed after the write.  The dates that have rows are
    counted while the rows are written, so ``df`` is planned and run once.
    """
    if window is None or window.mode not in ("batch", "changed"):
        write_table(df, path, mode="overwrite", partition_by=partition_by, cluster_by=cluster_by, dynamic=True)
        return
    seen = Observation()
    df = df.observe(seen, F.collect_set(F.col(partition_by[0]).cast("string")).alias("dates"))  # days of one run
    write_table(df, path, mode="overwrite", partition_by=partition_by, cluster_by=cluster_by, dynamic=True)
    clear_empty_dates(df.sparkSession, path, partition_by[0], window, set(seen.get["dates"] or ()))


def clear_empty_dates(spark, path: str, partition_col: str, window, have: set[str]) -> None:
    """Remove the partitions of ``path`` whose date lies in ``window`` but not among ``have`` (days of one run: bounded)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        key, _, value = status.getPath().getName().partition("=")
        if key == partition_col and value not in have and window.covers(value):
            fs.delete(status.getPath(), True)


def upsert(new: DataFrame, path: str, keys, partition_col: str = "PARTITION_DATE", cluster_by=()) -> None:
    """Keyed upsert into a date-partitioned Parquet table.

    result(touched partitions) = new rows  UNION  (target rows of those
    partitions whose key is not in ``new``); untouched partitions are not
    rewritten.  ``new`` is computed once, into a staging folder.  The touched
    dates are a bounded set (days of one run), so they are broadcast for the
    semi-join, which also lets dynamic partition pruning skip the other date
    directories.  The merged rows are staged before the overwrite because
    the job reads the directories it replaces.
    """
    spark = new.sparkSession
    schema = new.schema

    def staged(df: DataFrame) -> DataFrame:
        place = scratch_path(spark, "upsert-staging")
        df.write.parquet(place)
        return spark.read.schema(schema).parquet(place)

    new = staged(new)
    target = read_table(spark, path, like=new)
    dates = bounded_broadcast(new.select(partition_col).distinct(), max_rows=100_000)
    touched = target.join(dates, partition_col, "left_semi")
    kept = touched.join(new.select(*keys), list(keys), "left_anti")
    replace_partitions(staged(new.unionByName(kept.select(*new.columns))), path, (partition_col,), cluster_by)
