"""Connected sessions as a stream, against the batch form."""

import datetime as dt
import random

from pyspark.sql import functions as F

from viewgrid.plans import analytics as A
from viewgrid.session import scratch_path
from viewgrid.streaming import content_stream, session_stream

SCHEMA = "hash string, date_partition date, show_title string, channel_affiliate string, ts_start timestamp_ntz, ts_end timestamp_ntz"
DAY = dt.datetime(2024, 1, 1)


def rows(seed, n, hours=20):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        start = DAY + dt.timedelta(seconds=r.randrange(hours * 3600), microseconds=r.choice([0, 1, 500_000]))
        out.append((f"tv{r.randrange(4)}", DAY.date(), r.choice("AB"), r.choice(["N", None]), start, start + dt.timedelta(seconds=r.choice([11, 200, 900, 4000]))))
    return out


def batch(spark, data):
    got = A.connected_sessions(spark.createDataFrame(data, SCHEMA)).drop("island_no").collect()
    return sorted(map(tuple, got), key=repr)


def streamed(spark, lands, delay="3 days", close=True):
    landing, target, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("landing", "target", "checkpoint"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for data in lands:
        content_stream.land(spark.createDataFrame(data, schema).coalesce(1), landing)
        session_stream.run(spark, landing, target, checkpoint, schema, delay)
    if close:
        content_stream.land(session_stream.heartbeat(spark, schema, DAY + dt.timedelta(days=30)), landing)
        session_stream.run(spark, landing, target, checkpoint, schema, delay)
    out = spark.read.schema("hash string, show_title string, channel_affiliate string, island_start timestamp_ntz, island_end timestamp_ntz, sessions long, total_seconds long, date_partition date").parquet(target)
    out = out.select("hash", "date_partition", "show_title", "channel_affiliate", "island_start", "island_end", "sessions", "total_seconds")
    return sorted(map(tuple, out.collect()), key=repr)


def test_closed_sessions_equal_the_batch_form(spark):
    data = rows(1, 150)
    edge = DAY + dt.timedelta(hours=22)
    data += [("tv9", DAY.date(), "A", "N", edge, edge + dt.timedelta(seconds=60)),
             ("tv9", DAY.date(), "A", "N", edge + dt.timedelta(seconds=360), edge + dt.timedelta(seconds=400)),  # a gap of exactly 300 s
             ("tv9", DAY.date(), "A", "N", edge + dt.timedelta(seconds=700, microseconds=1), edge + dt.timedelta(seconds=720)),  # and a little more
             (None, DAY.date(), "A", "N", edge, edge + dt.timedelta(seconds=60))]
    data = list(dict.fromkeys(data))
    random.Random(2).shuffle(data)
    want = [x for x in batch(spark, data) if x[0] is not None]
    assert streamed(spark, [data[:60], data[60:]]) == want  # out of order
    assert streamed(spark, [data[:60], data[:60], data[40:]]) == want  # replayed


def test_open_sessions_wait_and_late_rows_are_dropped(spark):
    one = ("tv1", DAY.date(), "A", "N", DAY, DAY + dt.timedelta(minutes=10))
    joined = ("tv1", DAY.date(), "A", "N", DAY + dt.timedelta(minutes=12), DAY + dt.timedelta(minutes=20))
    assert streamed(spark, [[one]], close=False) == []
    later = ("tv2", DAY.date(), "A", "N", DAY + dt.timedelta(days=9), DAY + dt.timedelta(days=9, minutes=1))
    got = streamed(spark, [[one], [joined], [later], [("tv1", DAY.date(), "B", "N", DAY, DAY + dt.timedelta(minutes=1))]])
    assert [x[6] for x in got if x[0] == "tv1"] == [2] and len(got) == 2  # the last row came nine days late
