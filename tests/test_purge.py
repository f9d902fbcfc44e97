"""Opted-out devices leave the built tables; files without them stay untouched."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewgrid.plans import models
from viewgrid.plans.runner import purge_optouts, run_models
from viewgrid.session import scratch_path
from viewgrid.sinks import purge
from viewgrid.sources.binding import BoundSources, OPTIONAL, SCHEMAS
from viewgrid.sources.fixtures import Sources


def files(path):
    top = path.removeprefix("file:")
    return {os.path.join(d, f)[len(top):]: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def table(spark):
    path = scratch_path(spark, "purged")
    rows = spark.range(600).selectExpr("id % 6 AS day", "concat('tv', id div 6) AS device", "id")
    for k in range(3):  # three files a day, by device
        rows.where(f"id div 6 % 3 = {k}").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    return path, rows


def test_only_files_with_a_device_are_rewritten(spark):
    path, rows = table(spark)
    before = files(path)
    ids = spark.createDataFrame([("tv3",), ("tv6",), ("tv6",), (None,), ("nobody",)], "hash string")
    assert purge.purge(spark, path, ids, "device", ("day",)) == 6  # tv3 and tv6 lie in one file of each day
    after = files(path)
    same = before.keys() & after.keys()
    assert len(same) == 12 and all(before[f] == after[f] for f in same)
    got = {(r.day, r.device, r.id) for r in spark.read.parquet(path).collect()}
    assert got == {(r.day, r.device, r.id) for r in rows.where("device not in ('tv3', 'tv6')").collect()}
    assert purge.purge(spark, path, ids, "device", ("day",)) == 0 and files(path) == after


@pytest.mark.parametrize("at", ["drop", "move"])
def test_a_purge_that_stops_is_finished_by_the_next(spark, monkeypatch, at):
    path, rows = table(spark)
    ids = spark.createDataFrame([("tv3",), ("tv4",)], "hash string")
    calls, real = [], getattr(purge._Files, at)

    def stops(self, *a):
        calls.append(a)
        if len(calls) == 4:
            raise RuntimeError("stopped")
        return real(self, *a)

    monkeypatch.setattr(purge._Files, at, stops)
    with pytest.raises(RuntimeError):
        purge.purge(spark, path, ids, "device", ("day",))
    monkeypatch.undo()
    assert purge.purge(spark, path, ids, "device", ("day",)) == 0
    got = sorted(r.id for r in spark.read.parquet(path).collect())
    assert got == sorted(r.id for r in rows.where("device not in ('tv3', 'tv4')").collect())


def test_no_built_table_keeps_an_opted_out_device(spark):
    out = scratch_path(spark, "purge-warehouse")
    run_models(spark, SF_SMALL, out, ["content_detail", "content_summary", "attributes_latest", "agg_hh"])
    counts = {n: spark.read.parquet(f"{out}/{n}").count() for n in ("content_detail", "agg_hh")}
    done = purge_optouts(spark, SF_SMALL, out)
    assert set(done) == {"content_detail", "content_summary", "attributes_latest", "agg_hh"} and all(done.values())
    gone = [r.hash for r in Sources(spark, SF_SMALL).optout.collect()]
    for name in done:
        df = spark.read.parquet(f"{out}/{name}")
        ids = df.select(F.col("AKKIO_ID" if "AKKIO_ID" in df.columns else "AKKIO_HH_ID").alias("id"))
        assert ids.where(F.col("id").isin(gone)).count() == 0
        assert name not in counts or 0 < df.count() < counts[name]
    state = models.location_state(spark, f"{out}/_latest_location")
    assert state.read().where(F.col("hash").isin(gone)).count() == 0 and len(state.versions()) == 1


def test_feeds_that_no_model_reads_may_be_left_out(spark):
    src, root = Sources(spark, SF_SMALL), scratch_path(spark, "optional-feeds")
    binding = {n: {"path": f"{root}/{n}"} for n in SCHEMAS}
    for name in OPTIONAL:
        getattr(src, name).write.parquet(f"{root}/{name}")
    bound = BoundSources(spark, binding)
    for name in OPTIONAL:
        assert getattr(bound, name).exceptAll(getattr(src, name).select(*getattr(bound, name).columns)).count() == 0
    less = BoundSources(spark, {n: b for n, b in binding.items() if n not in OPTIONAL})
    with pytest.raises(ValueError, match="not bound: optout"):
        less.optout  # noqa: B018
