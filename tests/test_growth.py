"""Wide rows: not shuffled for a device map or an opt-out list, and dealt out evenly before a write by dates."""

import os

import pytest
from pyspark.sql import functions as F

from viewgrid.operators import enrich
from viewgrid.plans import models
from viewgrid.session import scratch_path
from viewgrid.sinks import purge, writers


@pytest.fixture
def no_small_tables(spark):
    """Spark itself broadcasts nothing, as where maps are larger than its threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def data_files(path):
    top = path.removeprefix("file:")
    return [os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")]


def one_file(spark, df, name):
    path = scratch_path(spark, name)
    df.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin"), plan.count("BroadcastHashJoin")


def ads(spark):
    texts = ["zipcode", "dma", "ip", "brand_name", "title", "prev_episode_id", "prev_title", "next_title", "prev_channel_callsign",
             "prev_network_affiliate", "next_episode_id", "next_channel_callsign", "next_network_affiliate", "live", "input_category",
             "input_device", "app_service"]
    times = ["ts_start", "ts_end", "prev_ts_start", "prev_ts_end", "next_ts_start", "next_ts_end"]
    rows = spark.range(60).selectExpr(
        "date_add(DATE'2024-01-01', cast(id % 4 as int)) AS date_partition", "if(id % 9 = 0, NULL, concat('tv', id % 7)) AS hash",
        "concat('CR', id % 5) AS value", "cast(id % 6 as double) AS duration", *[f"concat('{c} ', id % 3) AS {c}" for c in texts],
        *[f"timestamp_ntz'2024-01-01 00:00:00' AS {c}" for c in times])
    categories = spark.createDataFrame([("CR1", "Food / Beverage"), ("CR2", None)], "value string, commercial_category string")
    zones = spark.createDataFrame([("tv1", "A"), ("tv2", "B"), ("tv2", "C"), (None, "D"), ("tv9", "E")], "hash string, timezone string")
    return one_file(spark, rows, "ads"), one_file(spark, categories, "categories"), one_file(spark, zones, "zones")


def test_wide_ads_are_not_shuffled_for_time_zones(spark, no_small_tables, monkeypatch):
    feed = ads(spark)
    df = models.commercial_detail(*feed)
    assert joins(df) == (0, 2)
    monkeypatch.setattr(enrich, "DEVICE_BROADCAST_ROWS", 3)  # beyond the bounds: planned from sizes, the same rows
    other = models.commercial_detail(*feed)
    assert joins(other) == (1, 1)
    assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0
    assert df.where("TIMEZONE = 'C'").count() == df.where("TIMEZONE = 'B'").count() > 0  # a repeated key fans out, as before
    assert df.where("TIMEZONE IS NULL").count() > 0 == df.where("TIMEZONE = 'D'").count()


def test_joins_with_maps_beyond_their_bounds_are_dealt_over_many_tasks(spark, no_small_tables, monkeypatch):
    """Where a map is too large for a broadcast, wide rows go to more tasks than Spark's own number if the input is large."""
    monkeypatch.setattr(enrich, "bounded_broadcast", lambda df, *bounds: df)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, categories, zones = ads(spark)
    rows = rows.withColumn("value", F.expr("CASE WHEN title = 'title 0' THEN NULL WHEN title = 'title 1' THEN 'CR1' ELSE value END"))
    feed = one_file(spark, rows.unionAll(rows.limit(5)), "ads-twice"), categories.unionAll(categories), zones  # maps with repeated keys
    places = lambda df, where="true": df.where(where).select(F.spark_partition_id()).distinct().count()
    plain = models.commercial_detail(*feed)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        monkeypatch.setattr(enrich, "JOIN_BYTES", 100, raising=False)
        dealt = models.commercial_detail(*feed)
        assert joins(dealt) == (2, 0)
        assert dealt.exceptAll(plain).count() == 0 and plain.exceptAll(dealt).count() == 0 and dealt.count() == plain.count() > 60
        once = enrich.left_enrich(feed[0], categories, "value", "value", {"commercial_category": "c"}, small=True, spread_by=("hash",))
        assert places(once) > own
        assert places(once, "value IS NULL") > 1 and places(once, "value = 'CR1'") > 1  # no key is one task's alone
        assert "__place" not in once.columns and "__at" not in once.columns
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_content_takes_the_same_step(spark, no_small_tables):
    feed = one_file(spark, spark.range(30).selectExpr(
        "DATE'2024-01-01' AS date_partition", "concat('tv', id % 7) AS hash", "timestamp_ntz'2024-01-01 00:00:00' AS ts_start",
        "timestamp_ntz'2024-01-01 00:01:00' AS ts_end", *[f"concat('{c}', id % 3) AS {c}" for c in (
            "zipcode", "dma", "channel_affiliate", "channel_callsign", "episode_id", "show_title", "live", "input_category",
            "input_device", "app_service")], "DATE'2024-01-01' AS air_date"), "content")
    genres = one_file(spark, spark.createDataFrame([("episode_id1", "Drama")], "episode_id string, genre string"), "genres")
    assert joins(models.content_detail(feed, genres, ads(spark)[2])) == (0, 2)


def test_checked_tables_take_the_same_step(spark, no_small_tables, tmp_path):
    """What dq_expression writes before its checks: the feed's own join of events and parts is the only shuffled one."""
    from viewgrid.registry.base import project

    spark.range(40).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type",
                               "1.5D AS value").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(9).selectExpr("id AS p_partkey", "concat('n', id) AS p_name", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    df = project(spark, str(tmp_path)).ref("commercial_detail")
    assert joins(df) == (1, 2) and df.count() > 0


def test_checked_tables_are_dealt_where_maps_are_too_large(spark, no_small_tables, tmp_path, monkeypatch):
    """dq_expression's ad table: the join with categories beyond their bounds has partitions by the size of the input."""
    from viewgrid.registry.base import project

    spark.range(40).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type",
                               "1.5D AS value").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(9).selectExpr("id AS p_partkey", "concat('n', id) AS p_name", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    want = project(spark, str(tmp_path)).ref("commercial_detail")
    monkeypatch.setattr(enrich, "bounded_broadcast", lambda df, *bounds: df)
    monkeypatch.setattr(enrich, "JOIN_BYTES", 100, raising=False)
    df = project(spark, str(tmp_path)).ref("commercial_detail")
    assert df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 4  # both sides of both joins
    assert df.count() > 0 == df.exceptAll(want).count() == want.exceptAll(df).count()


@pytest.mark.parametrize("cluster", [(), ("AKKIO_ID",)])
def test_dates_of_large_inputs_are_dealt_over_many_tasks(spark, monkeypatch, cluster):
    rows = one_file(spark, spark.range(900).selectExpr(
        "date_add(DATE'2024-01-01', cast(id % 3 as int)) AS PARTITION_DATE", "concat('tv', id div 30) AS AKKIO_ID", "id", "map(id, 'x') AS m"), "rows")
    monkeypatch.setattr(writers, "BUCKET_BYTES", 1, raising=False)
    monkeypatch.setattr(writers, "MAX_BUCKETS", 8, raising=False)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # every task shows as a file
    try:
        path = scratch_path(spark, "dealt")
        writers.write_table(rows, path, partition_by=("PARTITION_DATE",), cluster_by=cluster)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = data_files(path)
    assert len(files) > 3 * 4  # one task wrote each date, from the one task that read the input
    back = spark.read.parquet(path).select("AKKIO_ID", F.col("id").cast("long"), F.col("PARTITION_DATE").cast("string"), F.map_values("m"))
    want = rows.select("AKKIO_ID", "id", F.col("PARTITION_DATE").cast("string"), F.map_values("m"))
    assert "__bucket" not in spark.read.parquet(path).columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_small_inputs_are_dealt_by_date_alone(spark):
    rows = one_file(spark, spark.range(90).selectExpr("id % 3 AS day", "id"), "few")
    assert writers.buckets(rows) == 1 and writers.buckets(spark.range(5)) == 1
    path = scratch_path(spark, "few-written")
    writers.write_table(rows, path, partition_by=("day",))
    assert len(data_files(path)) == 3


def test_a_purge_keeps_files_and_their_order(spark, no_small_tables):
    path = scratch_path(spark, "in-order")
    rows = spark.range(1200).selectExpr("if(id % 4 = 3, NULL, id % 4) AS day", "concat('tv', lpad(id div 8 % 50, 2, '0')) AS device", "id")
    for part in ("device < 'tv25'", "device >= 'tv25'"):
        rows.where(part).coalesce(1).sortWithinPartitions("day", "device").write.mode("append").partitionBy("day").parquet(path)
    before = data_files(path)
    ids = spark.createDataFrame([("tv03",), ("tv40",), (None,)], "hash string")
    assert purge.purge(spark, path, ids, "device", ("day",)) == len(before) == 8
    after = data_files(path)
    assert len(after) <= 8 and not set(after) & set(before)
    for f in after:
        devices = [r.device for r in spark.read.parquet(f).collect()]
        assert devices == sorted(devices)
    got = sorted((str(r.day), r.device, r.id) for r in spark.read.parquet(path).collect())
    assert got == sorted((str(r.day), r.device, r.id) for r in rows.where("device NOT IN ('tv03', 'tv40')").collect())
    assert not os.path.exists(f"{path.removeprefix('file:')}/_purge")
