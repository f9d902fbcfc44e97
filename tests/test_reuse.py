"""What is kept and reused between runs: sketches, device state, fingerprints; sweeps, components and bitmaps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewgrid.operators import manifest, sketches
from viewgrid.operators.components import components
from viewgrid.operators.device_state import DeviceState
from viewgrid.operators.incremental import Window
from viewgrid.operators.manifest import Manifest
from viewgrid.operators.sweep import seconds_per_bucket, under_way
from viewgrid.plans import analytics as A
from viewgrid.plans import audience as AU
from viewgrid.plans import models
from viewgrid.plans.project import Project
from viewgrid.plans.runner import run_models
from viewgrid.session import scratch_path
from viewgrid.sources.fixtures import Sources


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------ sketches
def test_reach_of_any_window_reads_no_detail_and_stays_within_its_bound(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("PARTITION_DATE"),
        F.concat(F.lit("tv"), (F.col("id") * 7919 % 41_000).cast("string")).alias("AKKIO_ID"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("TITLE"))
    path = scratch_path(spark, "daily-reach")
    sketches.daily_reach(rows, ["TITLE"]).write.partitionBy("PARTITION_DATE").parquet(path)
    for window in (None, Window("2024-01-02", "2024-01-04"), Window("2024-01-09", "2024-01-09")):
        daily = spark.read.parquet(path)
        got = {r.TITLE: r for r in sketches.reach_over(daily, ["TITLE"], window).collect()}
        exact = {r.TITLE: r for r in A.reach(sketches.apply_window(rows, "PARTITION_DATE", window), ["TITLE"]).collect()}
        assert got.keys() == exact.keys() == {"hot", None}
        for k, e in exact.items():
            assert got[k].views == e.views and abs(got[k].approx_reach - e.reach) <= sketches.ERROR_BOUND * e.reach
    text = plan(sketches.reach_over(daily, ["TITLE"], Window("2024-01-02", "2024-01-04")))
    assert text.count("FileScan") == 1 and "daily-reach" in text and "PartitionFilters: [isnotnull(PARTITION_DATE" in text


def test_overlaps_from_theta_sketches(spark):
    day = F.lit("2024-01-01").cast("date").alias("PARTITION_DATE")
    ids = spark.range(50_000).select("id", day, F.col("id").cast("string").alias("AKKIO_ID"))
    parts = {"a": ids.where("id % 2 = 0"), "b": ids.where("id % 3 = 0"), "every": ids.where("id < 40000")}
    cells = {(r.a, r.b): r.approx_devices for r in sketches.audience_cells(sketches.daily_audiences(parts), ["a", "b"], "every").collect()}
    want = {}
    for k in range(50_000):
        a, b = k % 2 == 0, k % 3 == 0
        if a or b or k < 40_000:
            want[a, b] = want.get((a, b), 0) + 1
    assert cells.keys() == want.keys()
    assert all(abs(cells[k] - v) <= sketches.ERROR_BOUND * sum(want.values()) for k, v in want.items())
    assert sketches.audience_cells(sketches.daily_audiences({"a": ids.limit(0), "every": ids.limit(0)}), ["a"], "every").collect() == []


def test_a_key_without_estimate_is_out_of_bounds(spark):
    exact = spark.createDataFrame([("x", 100), (None, 50), ("z", 1)], "k string, reach long")
    near = spark.createDataFrame([("x", 102.0), (None, 60.0), ("y", 1.0)], "k string, approx double")
    got = {r.k: (r.reach, r.within_bound) for r in A.sketch_check(near, exact, ["k"], "approx", "reach", 0.03 * F.col("reach")).collect()}
    assert got == {"x": (100, True), None: (50, False), "y": (None, False), "z": (1, False)}


def test_run_writes_sketches_by_day(spark):
    out = scratch_path(spark, "sketch-warehouse")
    select = ["commercial_detail", "reach_by_brand"]
    assert run_models(spark, SF_SMALL, out, select)["reach_by_brand"] == "full"
    before = {f: spark.read.parquet(f"{out}/reach_by_brand").count() for f in ("n",)}
    assert run_models(spark, SF_SMALL, out, select, start="2024-01-02", end="2024-01-03")["reach_by_brand"] == "batch"
    daily = spark.read.parquet(f"{out}/reach_by_brand")
    assert daily.count() == before["n"] and daily.schema["DEVICES"].metadata["comment"]
    got = {r.BRAND_NAME: r.views for r in sketches.reach_over(daily, ["BRAND_NAME"]).collect()}
    assert got == {r.BRAND_NAME: r.views for r in A.reach(spark.read.parquet(f"{out}/commercial_detail"), ["BRAND_NAME"]).collect()}


# ------------------------------------------------------------ sweep
ZONES = {"NY": "America/New_York", "KTM": "Asia/Kathmandu", "LA": "America/Los_Angeles", "none": None}


def sessions(spark, rows):
    rows = [(d, ZONES[z], dt.datetime.fromisoformat(t), n) for d, z, t, n in rows]
    return spark.createDataFrame(rows, "AKKIO_ID string, TIMEZONE string, SESSION_START_TIME_UTC timestamp_ntz, TOTAL_SECONDS long")


def by_minutes(rows):
    """Local hour -> (session count, seconds, devices), second by second in steps of a minute or less."""
    from zoneinfo import ZoneInfo

    seen = {}
    for k, (device, zone, start, n) in enumerate(rows):
        t = int(dt.datetime.fromisoformat(start + "+00:00").timestamp())
        end = t + n
        while t < end:
            step = min(end, (t // 60 + 1) * 60)
            hour = None if ZONES[zone] is None else dt.datetime.fromtimestamp(t, ZoneInfo(ZONES[zone])).hour
            s = seen.setdefault(hour, [set(), 0, set()])
            s[0].add(k)
            s[1] += step - t
            s[2].add(device)
            t = step
    return {h: (len(a), b, len(c)) for h, (a, b, c) in seen.items()}


def test_dayparts_over_midnight_and_clock_changes(spark):
    rows = [
        ("a", "NY", "2024-01-01T00:50:00", 3 * 3600),  # 19:50 local: ten minutes before prime, then prime
        ("a", "NY", "2024-01-02T04:30:30", 3600),  # over local midnight
        ("b", "NY", "2024-03-10T06:30:00", 2 * 3600),  # spring: no local hour 2
        ("b", "NY", "2024-11-03T04:10:10", 4 * 3600 + 7),  # autumn: local hour 1 twice
        ("c", "KTM", "2024-01-01T18:14:59", 62),  # +5:45, over local midnight
        ("c", "KTM", "2024-01-05T01:00:00", 4 * 86400 + 13),  # days long
        ("d", "LA", "2024-01-01T08:00:00", 3600), ("d", "LA", "2024-01-01T08:59:59", 1), ("d", "LA", "2024-01-01T07:45:00", 900),
        ("e", "none", "2024-01-01T08:00:00", 5000), ("f", "NY", "2024-01-01T08:00:00", 0),
    ]
    r = random.Random(1)
    rows += [(f"g{k % 9}", r.choice("NY KTM LA".split()), f"2024-0{r.randrange(1, 10)}-1{r.randrange(9)}T{r.randrange(24):02}:{r.randrange(60):02}:{r.randrange(60):02}",
              r.choice([1, 59, 900, 3600, 7201, r.randrange(1, 30_000)])) for k in range(150)]
    got = A.daypart_viewing(sessions(spark, rows)).collect()
    assert {x.local_hour: (x.sessions, x.seconds, x.viewers) for x in got} == by_minutes(rows)
    assert sum(x.seconds for x in got) == sum(n for *_, n in rows)
    part = {x.local_hour: x.daypart for x in got}
    assert part[20] == part[22] == "prime" and part[9] == part[16] == "daytime" and part[8] == part[23] == "other" and part[None] is None


def test_sweep_grows_with_time_and_not_with_sessions(spark):
    d = sessions(spark, [("a", "NY", "2024-01-01T00:00:00", 3600)]).crossJoin(spark.range(500)).drop("id")
    assert {(r.bucket % 4, r.seconds) for r in seconds_per_bucket(d, "SESSION_START_TIME_UTC", "TOTAL_SECONDS", ["TIMEZONE"], 900).collect()} == {(k, 450_000) for k in range(4)}
    rows = under_way(d, "SESSION_START_TIME_UTC", "TOTAL_SECONDS", ["TIMEZONE"], 60).collect()
    assert len(rows) == 60 and {r["rows"] for r in rows} == {500}


# ------------------------------------------------------------ device state
def test_daily_merges_equal_one_full_run(spark):
    device = Sources(spark, SF_SMALL).device
    want = {tuple(r) for r in models.latest_location(device).collect()}
    state = models.location_state(spark, scratch_path(spark, "state"))
    state.buckets = 7
    days = [r[0] for r in device.select("date_partition").where("date_partition is not null").distinct().collect()]
    random.Random(2).shuffle(days)
    for day in days[:6]:
        state.merge(device.where(F.col("date_partition") == F.lit(day)))
    state.merge(device.where(F.col("date_partition").isin(days[4:])))
    assert {tuple(r) for r in models.located(state.read()).collect()} == want
    assert len(state.versions()) == 2  # older ones are gone
    state.merge(device.where(F.col("date_partition").isin(days[:3])))  # again: nothing new
    assert {tuple(r) for r in models.located(state.read()).collect()} == want


def test_a_merge_shuffles_the_day_alone(spark):
    rows = [(f"tv{k}", k % 5, f"v{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "device string, at int, city string")
    state = DeviceState(spark, scratch_path(spark, "state"), "device", ["at"], ["city"], buckets=5)
    state.merge(df)
    day = spark.createDataFrame([("tv1", 9, "new"), ("tv2", 0, "old"), ("tv999", 1, "first"), (None, 9, "nobody"), ("tv1", 8, "x")], df.schema)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for more in (4, 40):  # fewer and more of them than buckets
        spark.conf.set("spark.sql.shuffle.partitions", more)
        above = plan(state.merged(day)).split("SortMergeJoin")[1]
        sides = above.split("FileScan")
        assert "Exchange" not in sides[0] and "Bucketed: true" in above  # the state's side comes first
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    state.merge(day)
    got = {r.device: (r["at"], r.city) for r in state.read().collect()}
    assert len(got) == 501 and got["tv1"] == (9, "new") and got["tv2"] == (2, "v2") and got["tv999"] == (1, "first")


def test_runs_keep_the_latest_locations(spark):
    out = scratch_path(spark, "state-warehouse")
    run_models(spark, SF_SMALL, out, ["attributes_latest"])
    run_models(spark, SF_SMALL, out, ["attributes_latest"], start="2024-01-02", end="2024-01-05")
    run_models(spark, SF_SMALL, out, ["attributes_latest"])
    want = Project(spark, SF_SMALL).ref("attributes_latest").drop("PARTITION_DATE")
    got = spark.read.parquet(f"{out}/attributes_latest").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


# ------------------------------------------------------------ fingerprints
def test_changed_dates(spark):
    day = [dt.date(2024, 1, d) for d in range(1, 7)]
    old = spark.createDataFrame([(d, f"tv{k}", k) for d in day[:5] for k in range(20)], "d date, id string, n int")
    book = Manifest(spark, scratch_path(spark, "manifest"))
    assert book.window(manifest.fingerprints(old, "d")).dates == tuple(day[:5])
    book.record(manifest.fingerprints(old.repartition(7), "d"))
    assert book.window(manifest.fingerprints(old.orderBy("n"), "d")).dates == ()
    new = old.where(F.col("d") != F.lit(day[0])).unionByName(spark.createDataFrame([(day[1], "late", 1), (day[5], "tv1", 1)], old.schema))
    new = new.withColumn("n", F.when((F.col("d") == F.lit(day[3])) & (F.col("n") == 7), None).otherwise(F.col("n")))
    assert book.window(manifest.fingerprints(new, "d")).dates == (day[0], day[1], day[3], day[5])


class Changing:
    """The feeds of a folder, with another content feed."""

    def __init__(self, base, content):
        self.base, self.content = base, content

    def __getattr__(self, name):
        return getattr(self.base, name)


def test_a_run_by_fingerprints_reloads_changed_dates_alone(spark):
    base, out = Sources(spark, SF_SMALL), scratch_path(spark, "changed-warehouse")
    content = base.content
    dates = sorted(r[0] for r in content.select("date_partition").distinct().collect())
    early = content.where((F.col("date_partition") != F.lit(dates[2])) | (F.minute("ts_start") < 30))
    select = ["content_detail", "reach_by_title"]
    run_models(spark, Changing(base, early), out, select, changed=True)
    files = lambda: {str(r[0]).split("/content_detail/")[1] for r in spark.read.parquet(f"{out}/content_detail").select(F.input_file_name()).distinct().collect()}
    before = files()
    late = content.where(F.col("date_partition") != F.lit(dates[4]))
    modes = run_models(spark, Changing(base, late), out, select, changed=True)
    assert set(modes.values()) == {"changed"}
    moved = {f.split("/")[0] for f in before ^ files()}
    assert moved == {f"PARTITION_DATE={dates[2]}", f"PARTITION_DATE={dates[4]}"}
    want = models.content_detail(late, base.genre_map, base.tz_map)
    got = spark.read.parquet(f"{out}/content_detail").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    views = spark.read.parquet(f"{out}/reach_by_title").agg(F.sum("VIEWS")).first()[0]
    assert views == want.count()


# ------------------------------------------------------------ components, identity, bitmaps
def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty"])
def test_components_equal_union_find(spark, kind):
    r = random.Random(kind)
    edges = {"random": [(f"n{r.randrange(300)}", f"n{r.randrange(300)}") for _ in range(220)], "chain": [(f"n{k:03}", f"n{k + 1:03}") for k in range(200)],
             "star": [(f"n{k}", "hot") for k in range(2000)] + [("a", "n7"), ("z", "z")], "empty": []}[kind]
    got = {x.node: x.component for x in components(spark.createDataFrame([*edges, (None, "x")], "a string, b string"), "a", "b").collect()}
    assert got == {k: v for k, v in union_find(edges).items() if k != "z"}


def test_identity_graph_joins_directly_and_through_others(spark):
    schema = AU.FIRST_PARTY_SCHEMA
    blank = dict.fromkeys(schema.names)
    hot = [{"client_record_id": f"h{k}", "phone": "555 0000", "ip": "1.1.1.1"} for k in range(400)]
    records = [
        {"client_record_id": "1", "email": " A@x.com", "ip": "9.9.9.9"}, {"client_record_id": "2", "email": "a@X.com ", "phone": "(555) 1"},
        {"client_record_id": "3", "phone": "5551", "maid": "M"}, {"client_record_id": "4", "ip": "9.9.9.9"}, {"client_record_id": "5", "phone": "none"}, *hot,
    ]
    fp = spark.createDataFrame([tuple((blank | x)[c] for c in schema.names) for x in records], schema)
    reg = spark.createDataFrame([("tv2", None, None, " m "), ("tv1", "b@x.com", "555-0000", None), ("tv3", None, None, None), (None, "a@x.com", None, None)], "tv_id string, email string, phone string, maid string")
    graph = AU.identity_graph(fp, reg)
    got = {(x.kind, x.id): x.person for x in graph.collect()}
    assert len(got) == len(records) + 3
    assert {got["record", k] for k in "123"} == {"device:tv2"} == {got["device", "tv2"]}
    assert got["record", "4"] == "record:4" and got["record", "5"] == "record:5" and got["device", "tv3"] == "device:tv3"
    assert {got["record", f"h{k}"] for k in range(400)} == {"device:tv1"}
    match = {x.client_record_id: tuple(x)[1:] for x in AU.identity_match(graph).collect()}
    assert match["2"] == ("device:tv2", "tv2", 1, 3) and match["4"] == ("record:4", None, 0, 1) and match["h7"] == ("device:tv1", "tv1", 1, 400)


def test_bitmaps_equal_sets(spark):
    r = random.Random(6)
    own = {"a": set(range(0, 70_000, 2)), "b": set(range(0, 70_000, 3)), "c": {r.randrange(70_000) for _ in range(500)}, "d": {1}}
    rows = [(s, f"tv{k:06}") for s, ids in own.items() for k in ids]
    seg = spark.createDataFrame(rows, "segment_id string, AKKIO_ID string").repartition(4)
    numbers = AU.device_numbers(seg)
    n = numbers.count()
    assert sorted(x.number for x in numbers.collect()) == list(range(n))
    pairs = [("a", "b"), ("c", "a"), ("d", "c"), ("a", "d")]
    got = {(x.a, x.b): (x.a_or_b, x.a_and_b, x.a_not_b) for x in AU.bitmap_sizes(AU.segment_bitmaps(seg, numbers), pairs).collect()}
    assert got == {(a, b): (len(own[a] | own[b]), len(own[a] & own[b]), len(own[a] - own[b])) for a, b in pairs}


def test_segment_algebra_reads_the_segments_once(spark):
    seg = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("b", "3"), ("c", "4")], "segment_id string, AKKIO_ID string")
    path = scratch_path(spark, "segments")
    seg.write.parquet(path)
    out = AU.segment_algebra(spark.read.parquet(path), "a", "b")
    assert plan(out).count("FileScan") == 1
    assert sorted((r.operation, r.AKKIO_ID) for r in out.collect()) == [("a&b", "2"), ("a-b", "1"), ("a|b", "1"), ("a|b", "2"), ("a|b", "3")]
