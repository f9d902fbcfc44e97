"""The skew-safe operators equal their single-window definitions, including
for one device holding most of the rows across many time buckets."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from viewgrid.operators.sessions import island_summary, islands, with_next
from viewgrid.operators.topn import first_by, last_by


def sessions_df(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(n):
        dev = "hot" if rnd.random() < 0.6 else f"d{rnd.randrange(20)}"
        net = rnd.choice(["a", "b", None])
        start = base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))
        end = start + dt.timedelta(seconds=rnd.randrange(-30, 900))
        rows.append((dev, net, start, end))
    return spark.createDataFrame(rows, "dev string, net string, s timestamp_ntz, e timestamp_ntz")


def brute_islands(df, keys, gap):
    w = Window.partitionBy(*keys).orderBy("s", "e")
    prev = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("new", F.when(prev.isNull() | (F.col("s") > prev + F.expr(f"INTERVAL {gap} SECONDS")), 1).otherwise(0))
    return x.withColumn("island_no", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_islands_equal_single_window(spark):
    df = sessions_df(spark)
    for bucket in ("hour", "minute", "day"):
        got = islands(df, ["dev", "net"], "s", "e", 300, bucket)
        assert same(got.select("dev", "net", "s", "e", "island_no"), brute_islands(df, ["dev", "net"], 300))


def test_island_summary_matches(spark):
    df = sessions_df(spark)
    ref = brute_islands(df, ["dev", "net"], 300).groupBy("dev", "net", "island_no").agg(
        F.min("s").alias("island_start"), F.max("e").alias("island_end"), F.count(F.lit(1)).alias("sessions"),
        F.sum(F.timestamp_diff("SECOND", F.col("s"), F.col("e"))).alias("total_seconds"))
    assert same(island_summary(df, ["dev", "net"], "s", "e", 300), ref)


def test_with_next_equals_lead(spark):
    df = sessions_df(spark).withColumn("id", F.monotonically_increasing_id().cast("string"))
    df = df.cache()  # ids from monotonically_increasing_id must not be recomputed
    got = with_next(df, ["dev"], "s", ["s", "e", "id"], ["id"])
    w = Window.partitionBy("dev").orderBy("s", "e", "id")
    ref = df.withColumn("next_id", F.lead("id").over(w))
    assert same(got.select("id", "next_id"), ref.select("id", "next_id"))
    df.unpersist()


def test_top1_aggregates_equal_row_number(spark):
    df = sessions_df(spark)
    w = Window.partitionBy("dev").orderBy("s", "e")
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("dev", "net", "s")
    assert same(first_by(df, ["dev"], ["s", "e"], ["net", "s"]).select("dev", "net", "s"), ref)
    w2 = Window.partitionBy("dev").orderBy(F.col("s").desc(), F.col("e").desc())
    ref2 = df.withColumn("rn", F.row_number().over(w2)).filter("rn = 1").select("dev", "net", "s")
    assert same(last_by(df, ["dev"], ["s", "e"], ["net", "s"]).select("dev", "net", "s"), ref2)


def test_models_with_a_hot_device_equal_window_forms(spark):
    """A third of the device feed rewritten onto one device (derived from the
    given tables): the min_by/max_by models equal the window definitions."""
    from conftest import SF_SMALL
    from viewgrid.plans import models
    from viewgrid.sources.fixtures import Sources

    s = Sources(spark, SF_SMALL)
    hot = s.device.withColumn("hash", F.when(F.pmod(F.xxhash64("ts_start", "city"), F.lit(3)) == 0, F.lit("tvHOT"))
                              .otherwise(F.col("hash")))
    got = models.standard_detail(hot, s.tz_map).select("PARTITION_DATE", "AKKIO_ID", "TOTAL_SECONDS", "CITY", "ZIP_CODE")
    w = Window.partitionBy("date_partition", "hash")
    ref = (hot.filter(F.col("hash").isNotNull())
           .withColumn("rn", F.row_number().over(w.orderBy("ts_start", "ts_end", "city", "zipcode")))
           .withColumn("tot", F.sum(F.timestamp_diff("SECOND", F.col("ts_start"), F.col("ts_end"))).over(w))
           .filter("rn = 1")
           .select(F.col("date_partition").alias("PARTITION_DATE"), F.col("hash").alias("AKKIO_ID"),
                   F.col("tot").alias("TOTAL_SECONDS"), F.col("city").alias("CITY"), F.col("zipcode").alias("ZIP_CODE")))
    assert same(got, ref)
    assert hot.filter(F.col("hash") == "tvHOT").count() > hot.count() / 4
    latest = models.latest_location(hot)
    w2 = Window.partitionBy("hash").orderBy(*[F.col(c).desc() for c in models.LATEST_LOCATION_ORDER])
    ref2 = hot.filter(F.col("hash").isNotNull()).withColumn("rn", F.row_number().over(w2)).filter("rn = 1").select(
        "hash", "city", F.col("iso_state").alias("state"), "dma", F.col("zipcode").alias("zip_code"))
    assert same(latest, ref2)
