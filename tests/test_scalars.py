"""Scalar queries whose SQL names two columns alike but for case: the rows can be written, read back and match the SQL."""

import datetime as dt
from collections import Counter

import pytest

import __spark_entry__ as E
from viewgrid.session import scratch_path

NAMES = ["std_brand", "std_category", "std_title_regex"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Events and parts of our own, some rows twice."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = tmp_path_factory.mktemp("scalars")
    at = dt.datetime(2024, 1, 5, 6, 7, 8)
    ids = [*range(40), 3, 3]
    pq.write_table(pa.table({
        "event_id": pa.array(ids, pa.int64()), "ts": pa.array([at] * len(ids), pa.timestamp("us")),
        "user_id": pa.array([i % 7 for i in ids], pa.int64()),
        "event_type": ["view"] * len(ids), "value": [1.5] * len(ids)}), f"{root}/events.parquet")
    keys = list(range(12))
    pq.write_table(pa.table({
        "p_partkey": pa.array(keys, pa.int64()), "p_name": [f"name {k}" for k in keys],
        "p_brand": [f"Brand_{k}, x" for k in keys], "p_type": [f"LARGE,  TIN-{k}" for k in keys]}), f"{root}/part.parquet")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_rows_can_be_written(spark, tables, name):
    import duckdb

    df = E.queries()[name](spark, tables)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.parquet(path)
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet')")
    con.execute(f"CREATE TABLE stored AS {E.oracle_sql()[name]}")
    want = con.execute("SELECT * FROM stored")
    assert back.columns == [d[0] for d in want.description]
    assert Counter(map(tuple, back.collect())) == Counter(want.fetchall())
