"""The build path on real bindings, back-fills, staging, comments, and the answers fixed after review."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewgrid.operators import quality
from viewgrid.operators.enrich import bounded_broadcast
from viewgrid.operators.incremental import Window
from viewgrid.plans import analytics as A
from viewgrid.plans import audience as AU
from viewgrid.plans.runner import _read, main, run_models
from viewgrid.session import scratch_path
from viewgrid.sinks import writers
from viewgrid.sources.binding import SCHEMAS, BoundSources, assert_unique
from viewgrid.sources.fixtures import Sources


def bind(spark, root):
    """Every feed written separately, one as CSV and one with other column names."""
    src = Sources(spark, SF_SMALL)
    binding = {}
    for name in SCHEMAS:
        df, path = getattr(src, name), f"{root}/{name}"
        binding[name] = {"path": path}
        if name == "genre_map":
            df.write.option("header", "true").csv(path)
            binding[name] |= {"format": "csv", "options": {"header": "true"}}
        elif name == "tz_map":
            df.withColumnRenamed("timezone", "Zone Name").write.parquet(path)
            binding[name] |= {"columns": {"timezone": "Zone Name"}}
        else:
            df.write.parquet(path)
    return binding


def test_models_run_from_bound_feeds(spark):
    root, out = scratch_path(spark, "feeds"), scratch_path(spark, "bound-warehouse")
    binding = bind(spark, root)
    spark.createDataFrame([(json.dumps(binding),)], "value string").coalesce(1).write.text(f"{root}/binding")
    assert main(["run", "--sources", f"{root}/binding", "--out", out, "--master", "local[4]"]) == 0
    plain = scratch_path(spark, "plain-warehouse")
    run_models(spark, SF_SMALL, plain)
    for name in ("content_detail", "commercial_summary", "agg_ind", "campaign_fbfs"):
        a, b = _read(spark, f"{out}/{name}"), _read(spark, f"{plain}/{name}")
        assert a.count() > 0 and a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    latest = _read(spark, f"{out}/attributes_latest")
    today = spark.sql("SELECT current_date()").first()[0]
    assert latest.select("PARTITION_DATE").distinct().first()[0] == today and "DBT_UPDATED_AT" in latest.columns
    hh = _read(spark, f"{out}/agg_hh")
    assert hh.schema["INCOME"].metadata["comment"] and writers.table_comment(hh) == writers.MODEL_COMMENTS["agg_hh"]
    assert writers.table_comment(_read(spark, f"{out}/content_detail")) == writers.MODEL_COMMENTS["content_detail"]


def test_bindings_are_checked(spark):
    with pytest.raises(ValueError, match="not bound"):
        BoundSources(spark, {})
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError, match="occur more than once"):
        assert_unique(twice, ["k"], "feed")


def test_backfill_clears_dates_that_lost_their_rows(spark):
    path = scratch_path(spark, "backfill")
    rows = [(dt.date(2024, 1, d), f"tv{d}") for d in range(1, 6)]
    df = spark.createDataFrame(rows, "PARTITION_DATE date, AKKIO_ID string")
    writers.write_table(df, path, partition_by=("PARTITION_DATE",))
    again = df.where("PARTITION_DATE = DATE '2024-01-02'").withColumn("AKKIO_ID", F.lit("new"))
    writers.replace_partitions(again, path, window=Window("2024-01-02", "2024-01-04"))
    left = {(str(r.PARTITION_DATE), r.AKKIO_ID) for r in spark.read.parquet(path).collect()}
    assert left == {("2024-01-01", "tv1"), ("2024-01-02", "new"), ("2024-01-05", "tv5")}


def test_upsert_computes_its_input_once(spark):
    path = scratch_path(spark, "upsert-once")
    schema = "PARTITION_DATE date, AKKIO_ID string, n int"
    old = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1), (dt.date(2024, 1, 1), "b", 1), (dt.date(2024, 1, 2), "a", 1)], schema)
    writers.write_table(old, path, partition_by=("PARTITION_DATE",))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    new = spark.createDataFrame([(dt.date(2024, 1, 1), "b", 2), (dt.date(2024, 1, 1), "c", 2)], schema).coalesce(1).mapInArrow(count, schema)
    writers.upsert(new, path, ["PARTITION_DATE", "AKKIO_ID"])
    assert seen.value == 2
    got = sorted((str(r.PARTITION_DATE), r.AKKIO_ID, r.n) for r in writers.read_table(spark, path, like=old).collect())
    assert got == [("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-01", "c", 2), ("2024-01-02", "a", 1)]


def test_partitioned_writes_keep_their_order(spark):
    path = scratch_path(spark, "ordered")
    df = spark.range(5000).select(F.lit(dt.date(2024, 1, 1)).alias("PARTITION_DATE"), F.md5(F.col("id").cast("string")).alias("AKKIO_ID"))
    writers.write_table(df.repartition(6), path, partition_by=("PARTITION_DATE",), cluster_by=("AKKIO_ID",))
    back = spark.read.parquet(path).select("AKKIO_ID", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    by = {}
    for r in sorted(back, key=lambda r: r.i):
        by.setdefault(r.f, []).append(r.AKKIO_ID)
    assert all(v == sorted(v) for v in by.values())


def test_only_a_missing_table_reads_as_none(spark):
    root = scratch_path(spark, "not-a-table")
    assert _read(spark, f"{root}/nothing") is None
    spark.createDataFrame([("x",)], "value string").write.text(root)
    with pytest.raises(Exception):  # noqa: B017 - a folder that holds no Parquet
        _read(spark, root).collect()


def test_size_check_is_partially_aggregated_and_takes_both_branches(spark):
    df = spark.range(1000).withColumn("name", F.lit("x" * 50))
    assert "broadcast" in bounded_broadcast(df)._jdf.queryExecution().toString().lower()
    for more in ({"max_rows": 999}, {"max_bytes": 1000}):
        assert "broadcast" not in bounded_broadcast(df, **more)._jdf.queryExecution().analyzed().toString().lower()


def test_scans_are_not_reshuffled(spark):
    plan = Sources(spark, SF_SMALL)["fx_content"]._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "Exchange" not in plan


def test_transitions_and_breaks_cross_midnight(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    rows = [
        ("tv1", dt.date(2024, 1, 1), "a", t("2024-01-01 23:00:00"), t("2024-01-01 23:59:50")),
        ("tv1", dt.date(2024, 1, 2), "b", t("2024-01-02 00:00:05"), t("2024-01-02 00:30:00")),
    ]
    d = spark.createDataFrame(rows, "AKKIO_ID string, PARTITION_DATE date, TITLE string, SESSION_START_TIME_UTC timestamp, SESSION_END_TIME_UTC timestamp")
    assert {r.TITLE: r.retained_viewers for r in A.retention(d).collect()} == {"a": 1, "b": 0}
    ads = d.select("AKKIO_ID", "PARTITION_DATE", F.col("SESSION_START_TIME_UTC").alias("AD_MATCH_START_TIME_UTC"),
                   F.col("SESSION_END_TIME_UTC").alias("AD_MATCH_END_TIME_UTC"), F.lit(30).alias("AD_LENGTH"), F.col("TITLE").alias("BRAND_NAME"))
    assert [r.sessions for r in A.ad_breaks(ads).collect()] == [2]


def test_person_key_needs_some_pii(spark):
    df = spark.createDataFrame([("1", None, None, None), ("2", " ", "none", ""), ("3", "A@x.io ", None, None), ("4", "a@x.io", "", " ")],
                               "client_record_id string, email string, phone string, zip string")
    keys = {r.client_record_id: r.person_key for r in AU.person_key(df).collect()}
    assert keys["1"] is None and keys["2"] is None and keys["3"] == keys["4"] is not None


def test_client_files_quarantine_what_does_not_parse(spark):
    path = scratch_path(spark, "client-csv")
    names = AU.FIRST_PARTY_SCHEMA.names
    good = ["1", "a@b.io", "", "12345", "", "", "12.5", "", ""]
    bad = ["2", "a@b.io", "", "12345", "", "", "NOTNUM", "", ""]
    lines = [",".join(names), ",".join(good), ",".join(bad)]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    got = {r.client_record_id: r for r in AU.validate_first_party(AU.read_first_party(spark, path)).collect()}
    assert got["1"].ingest_status == "accepted" and got["2"].ingest_status == "quarantined" and "unparsable" in got["2"].reject_reason
    other = scratch_path(spark, "client-header")
    spark.createDataFrame([("id,mail\n1,x",)], "value string").coalesce(1).write.text(other)
    with pytest.raises(ValueError, match="header"):
        AU.read_first_party(spark, other)


def test_segments_are_data(spark):
    viewing = spark.createDataFrame([("tv1", 10), ("tv1", 20), ("tv2", 5), ("tv3", 50)], "AKKIO_ID string, n int")
    people = spark.createDataFrame([("tv2", 30), ("tv3", 70)], "AKKIO_ID string, AGE int")
    rules = [AU.Rule("heavy", "viewing", "n > 5", least_rows=2), AU.Rule("any", "viewing", "n > 5"), AU.Rule("any", "people", F.col("AGE") > 20)]
    got = sorted((r.segment_id, r.AKKIO_ID) for r in AU.segments({"viewing": viewing, "people": people}, rules).collect())
    assert got == [("any", "tv1"), ("any", "tv2"), ("any", "tv3"), ("heavy", "tv1")]


def test_exports_need_secrets_of_their_own(spark):
    seg = spark.createDataFrame([("s", "tv1")], "segment_id string, AKKIO_ID string")
    rows = AU.export_rows(seg, {"a": "one", "b": "two"}).collect()
    assert len({r.hashed_id for r in rows}) == 2
    for salts in ({"a": "one", "b": "one"}, {"a": ""}):
        with pytest.raises(ValueError):
            AU.export_rows(seg, salts)


def test_identity_rules_in_order(spark):
    fp = spark.createDataFrame(
        [("1", "x@y.io", None, None, "9", "tv9"), ("2", "X@Y.io", "1 2", None, "9", None), ("3", None, "1-2", "M", "9", None), ("4", None, None, "m", "9", None),
         ("5", None, None, None, "9", None), ("6", None, None, None, None, None)],
        "client_record_id string, email string, phone string, maid string, ip string, known_tv_id string")
    reg = spark.createDataFrame([("tv1", "x@y.io", None, None), ("tv2", None, "12", None), ("tv3", None, None, "m")], "tv_id string, email string, phone string, maid string")
    ips = spark.createDataFrame([("ip", "9", "tv4")], "method string, key string, tv_id string")
    got = {r.client_record_id: (r.tv_id, r.match_method) for r in AU.id_match(fp, AU.contact_graph(reg).unionByName(ips)).collect()}
    assert got == {"1": ("tv9", "known_id"), "2": ("tv1", "email"), "3": ("tv2", "phone"), "4": ("tv3", "maid"), "5": ("tv4", "ip"), "6": (None, "unmatched")}


def test_days_without_rows_are_reported(spark):
    rows = [("a", dt.date(2024, 1, d), 10) for d in (1, 2, 4)] + [("b", dt.date(2024, 1, 5), 7), ("b", None, 3)]
    out = quality.row_count_trend(spark.createDataFrame(rows, "t string, day date, n long"), "t", "day", "n")
    assert {(r.t, r.day.day): r.missing for r in out.collect()} == {("a", 1): False, ("a", 2): False, ("a", 3): True, ("a", 4): False, ("a", 5): True, ("b", 5): False}


def test_every_failed_check_is_listed(spark):
    rows = [("t", f"c{k}", "not_null", "fail") for k in range(64)]
    with pytest.raises(AssertionError, match="c63"):
        quality.raise_on_error(spark.createDataFrame(rows, "table_name string, column_name string, check_name string, status string"))
