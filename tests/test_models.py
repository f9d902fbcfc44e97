"""Invariants, incremental properties and plan-shape checks."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewgrid.operators.incremental import Window, high_water, window_for
from viewgrid.plans import models
from viewgrid.plans.project import Project
from viewgrid.session import scratch_path
from viewgrid.sinks import writers
from viewgrid.sources.fixtures import Sources


def test_seconds_roll_up(spark):
    p = Project(spark, SF_SMALL)
    a = p.ref("content_detail").agg(F.sum("TOTAL_SECONDS")).first()[0]
    b = p.ref("content_summary").agg(F.sum("TOTAL_VIEWING_SECONDS")).first()[0]
    assert a == b


def test_title_map_counts_equal_detail_rows(spark):
    p = Project(spark, SF_SMALL)
    m = p.ref("agg_media").select("PARTITION_DATE", "AKKIO_ID",
                                  F.aggregate(F.map_values("TITLES_WATCHED"), F.lit(0).cast("long"),
                                              lambda a, x: a + x).alias("n"))
    d = p.ref("content_detail").groupBy("PARTITION_DATE", "AKKIO_ID").agg(F.count(F.lit(1)).alias("n"))
    assert m.exceptAll(d).count() == 0 and d.exceptAll(m).count() == 0


def test_single_pass_maps_equal_five_joins(spark):
    d = Project(spark, SF_SMALL).ref("content_detail")
    def flat(df):
        fams = list(models.media_categories())
        x = df.select("PARTITION_DATE", "AKKIO_ID", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("m"))
                                                                        for f in fams])).alias("t"))
        return x.select("PARTITION_DATE", "AKKIO_ID", "t.f", F.explode("t.m"))
    a, b = flat(models.agg_media(d)), flat(models.agg_media_by_joins(d))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_left_joins_keep_rows_on_unique_maps(spark):
    s = Sources(spark, SF_SMALL)
    filtered = s.commercial.filter(F.col("hash").isNotNull() & (F.col("duration") > 0)).count()
    assert models.commercial_detail(s.commercial, s.category_map, s.tz_map).count() == filtered


def test_daily_increments_equal_full_load(spark):
    s = Sources(spark, SF_SMALL)
    full = models.content_detail(s.content, s.genre_map, s.tz_map)
    path = scratch_path(spark, "inc_test")
    days = [r[0] for r in full.select("PARTITION_DATE").distinct().orderBy("PARTITION_DATE").collect()]
    for d in days[:3]:
        writers.append(models.content_detail(s.content, s.genre_map, s.tz_map, Window(d, d)), path)
    for _ in range(3):  # high-water runs until nothing is left
        target = writers.read_table(spark, path, like=full)
        w = window_for(target)
        writers.append(models.content_detail(s.content, s.genre_map, s.tz_map, w), path)
    got = writers.read_table(spark, path, like=full)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_window_rerun_is_idempotent(spark):
    s = Sources(spark, SF_SMALL)
    full = models.content_detail(s.content, s.genre_map, s.tz_map)
    path = scratch_path(spark, "replace_test")
    writers.write_table(full, path, partition_by=("PARTITION_DATE",))
    n = full.count()
    for _ in range(2):
        writers.replace_partitions(models.content_detail(s.content, s.genre_map, s.tz_map,
                                                         Window("2024-01-02", "2024-01-03")), path)
    assert writers.read_table(spark, path, like=full).count() == n


def test_high_water_empty_target_loads_everything(spark):
    empty = spark.createDataFrame([], "PARTITION_DATE date")
    assert high_water(empty) is None
    assert window_for(empty).mode == "full"
    assert window_for(None, "2024-01-01", "2024-01-02").mode == "batch"


def test_upsert_replaces_keys_and_keeps_others(spark):
    path = scratch_path(spark, "upsert_test")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "PARTITION_DATE date, AKKIO_ID string, v long"
    writers.write_table(spark.createDataFrame([(d1, "a", 1), (d1, "b", 1), (d2, "a", 1)], schema), path,
                        partition_by=("PARTITION_DATE",))
    new = spark.createDataFrame([(d1, "a", 9), (d1, "c", 9)], schema)
    writers.upsert(new, path, ["PARTITION_DATE", "AKKIO_ID"])
    got = sorted(tuple(r) for r in writers.read_table(spark, path, like=new).collect())
    assert got == [(d1, "a", 9), (d1, "b", 1), (d1, "c", 9), (d2, "a", 1)]


def test_comments_persist(spark):
    df = Project(spark, SF_SMALL).ref("agg_hh")
    path = scratch_path(spark, "comments_test")
    writers.write_model(df, path, "agg_hh")
    back = spark.read.parquet(path)
    assert back.schema["INCOME"].metadata["comment"] == writers.COLUMN_COMMENTS["INCOME"]
    assert writers.table_comment(back) == writers.MODEL_COMMENTS["agg_hh"]


def test_date_window_reaches_parquet_scan(spark):
    p = Project(spark, SF_SMALL, window=Window("2024-01-05", "2024-01-12"))
    plan = p.ref("content_detail")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "GreaterThanOrEqual(ts" in plan
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan


def test_mapping_broadcast_is_size_checked(spark):
    from viewgrid.operators.enrich import bounded_broadcast
    small = spark.range(10)
    assert "broadcast" in bounded_broadcast(small, 100)._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(1000)
    assert "broadcast" not in bounded_broadcast(big, 100)._jdf.queryExecution().analyzed().toString().lower()


def test_dq_report_shape(spark):
    import __spark_entry__ as E
    r = E.queries()["dq_report"](spark, SF_SMALL)
    rows = r.collect()
    assert len(rows) == 64
    statuses = {(x.table_name, x.column_name, x.check_name): x.status for x in rows}
    # the household INCOME range check compares dollars against 0-500: it warns
    assert statuses[("agg_hh", "INCOME", "accepted_range(0,500)")] == "warn"
    assert all(x.status != "fail" for x in rows)


def test_stream_rerun_adds_nothing_and_picks_up_new_files(spark):
    from viewgrid.streaming import content_stream
    s = Sources(spark, SF_SMALL)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("t_landing", "t_target", "t_ckpt"))
    feed = s.content
    early = feed.filter(F.col("date_partition") <= F.lit("2024-01-10").cast("date"))
    late = feed.filter(F.col("date_partition") > F.lit("2024-01-10").cast("date"))
    content_stream.land(early, landing)
    content_stream.run(spark, landing, target, ckpt, feed.schema, s.genre_map, s.tz_map)
    n1 = content_stream.read_target(spark, target).count()
    content_stream.run(spark, landing, target, ckpt, feed.schema, s.genre_map, s.tz_map)  # nothing new
    assert content_stream.read_target(spark, target).count() == n1
    content_stream.land(late, landing)
    content_stream.run(spark, landing, target, ckpt, feed.schema, s.genre_map, s.tz_map)
    full = models.content_detail(feed, s.genre_map, s.tz_map)
    got = content_stream.read_target(spark, target).select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_materialize_levels_and_reads_back(spark):
    p = Project(spark, SF_SMALL)
    levels = p._levels(["campaign_nbc", "content_summary"])
    assert levels[0] == ["content_detail", "attributes_latest"] and set(levels[1]) == {"content_summary", "campaign_nbc"}
    expect = Project(spark, SF_SMALL).ref("campaign_nbc")
    paths = p.materialize(["campaign_nbc", "content_summary"], scratch_path(spark, "mat_test"))
    assert set(paths) == {"content_detail", "attributes_latest", "content_summary", "campaign_nbc"}
    got = p.ref("campaign_nbc")
    # downstream of the lineage cut: the plan reads the written table, not the raw feeds
    assert "events.parquet" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_runner_full_then_incremental_then_backfill(spark):
    from viewgrid.plans.runner import run_models, test_models
    out = scratch_path(spark, "warehouse")
    modes = run_models(spark, SF_SMALL, out)
    assert modes["content_detail"] == "full" and modes["content_summary"] == "table"
    expect = Project(spark, SF_SMALL)
    counts = {n: spark.read.parquet(f"{out}/{n}").count() for n in ("content_detail", "commercial_summary",
                                                                      "campaign_fbfs", "agg_media")}
    for n, c in counts.items():
        assert c == expect.ref(n).count(), n
    modes = run_models(spark, SF_SMALL, out)                      # nothing new after the high-water mark
    assert modes["content_detail"] == "incremental"
    modes = run_models(spark, SF_SMALL, out, select=["content_detail", "commercial_detail", "commercial_summary"],
                       start="2024-01-02", end="2024-01-04")      # overlapping back-fill
    assert modes["commercial_summary"] == "batch"
    for n, c in counts.items():
        assert spark.read.parquet(f"{out}/{n}").count() == c, n
    got = spark.read.parquet(f"{out}/commercial_summary").select(*expect.ref("commercial_summary").columns)
    assert got.exceptAll(expect.ref("commercial_summary")).count() == 0
    rep = test_models(spark, out).collect()
    assert len(rep) == 64 and all(r.status != "fail" for r in rep)


def test_broadcast_respects_byte_bound(spark):
    from viewgrid.operators.enrich import bounded_broadcast
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("s"))   # ~50 KB of payload
    plan = lambda df: df._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in plan(bounded_broadcast(wide, max_rows=100, max_bytes=1_000_000))
    assert "broadcast" not in plan(bounded_broadcast(wide, max_rows=100, max_bytes=10_000))


def test_cli_build_selected_models(spark, capsys):
    from viewgrid.plans.runner import main
    out = scratch_path(spark, "cli_warehouse")
    rc = main(["build", "--sf", SF_SMALL, "--out", out, "--select", "content_detail,content_summary"])
    printed = capsys.readouterr().out
    assert rc == 0
    assert "content_detail: full" in printed and "content_summary: table" in printed
    assert spark.read.parquet(f"{out}/content_summary").count() == Project(spark, SF_SMALL).ref("content_summary").count()
