"""Session construction and the shared scratch location.

Nothing in the library creates a SparkSession implicitly: functions take the
session (or DataFrames) they work on.  ``get_session`` is for tests, the bench
and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins from runtime sizes (a mapping
# table that turns out small is broadcast, a hot device key is split by the
# skew-join rule) and coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "viewgrid", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the recommended settings.

    ``master`` defaults to ``local[$VIEWGRID_CPUS or 8]``.  On a cluster, pass
    ``master=""`` (keep spark-submit's master) and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); AQE coalesces what is too many.
    """
    cpus = int(os.environ.get("VIEWGRID_CPUS", os.environ.get("BENCH_CPUS", "8")))
    builder = SparkSession.builder.appName(app_name)
    if master != "":  # "" = keep the master given by spark-submit / the cluster
        builder = builder.master(master or f"local[{cpus}]")
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.driver.memory"] = os.environ.get("VIEWGRID_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Directory shared by all executors for lineage cuts and written tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    directory).  When neither is set, a session on a local master gets a fresh
    directory, registered as the checkpoint directory; on a cluster that would
    be a folder of the driver alone, so there it is an error.
    """
    try:
        d = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - conf key absent
        d = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the conf is visible
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from None
        return d.rstrip("/")
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if d and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)  # configured folder, so DataFrame.checkpoint() can use it
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="viewgrid-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder for one table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
