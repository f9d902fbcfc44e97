"""A lookup by device id reads only the row groups whose Bloom filter admits it."""

from pyspark.sql import functions as F

from viewgrid.session import scratch_path
from viewgrid.sinks.writers import write_table

FILES = 12


def rows_read(df):
    """Rows that the scan of ``df`` handed on, and the result's rows."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        found = plan.executeCollect()
        return plan.collectLeaves().head().metrics().get("numOutputRows").get().value(), len(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_of_one_device_skips_row_groups(spark):
    n = 480_000  # too many ids in a file for a dictionary, which would rule row groups out as well
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("AKKIO_ID"), (F.col("id") % 5).alias("v")).repartition(FILES)
    plain, bloom = scratch_path(spark, "ids-plain"), scratch_path(spark, "ids-bloom")
    rows.write.parquet(plain)
    write_table(rows, bloom)
    wanted = rows.orderBy("AKKIO_ID").offset(700).first()["AKKIO_ID"]
    read = {}
    for path in (plain, bloom):
        read[path], found = rows_read(spark.read.parquet(path).where(F.col("AKKIO_ID") == wanted))
        assert found == 1
    assert 0 < read[bloom] <= 3 * n // FILES < read[plain] // 2
    ids = [r.AKKIO_ID for r in rows.limit(2).collect()]
    many, found = rows_read(spark.read.parquet(bloom).where(F.col("AKKIO_ID").isin(ids)))
    assert found == 2 and many <= 5 * n // FILES
