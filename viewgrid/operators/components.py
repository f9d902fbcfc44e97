"""Connected components of a table of edges between nodes of any orderable type.

Every node points to the least node it knows of; a round links all ends of its
edges to that least one and drops the longer way, first for the neighbours that
are larger than the node, then for those that are smaller (large and small stars).
Edges never become pairs: a hot node stays a star, its minimum is combined map-side
and its join side can be split at run time.  Rounds are written to the shared folder, so a
lost executor doesn't repeat earlier ones, and end when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """Edges as (node, root): the smaller end is the root; loops and repeats are gone."""
    return edges.select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).where("node <> root").distinct()


def _round(edges: DataFrame) -> DataFrame:
    ways = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    low = ways.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("low"))
    large = _stars(ways.join(low, "node").where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root")))
    low = large.groupBy("node").agg(F.min("root").alias("low"))
    small = large.join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
    return _stars(small.unionByName(low.select("node", F.col("low").alias("root"))))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of an edge: the least node that it reaches."""
    print_ = [F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))]  # of a set of edges
    now = _written(_stars(edges.select(F.col(a).alias("node"), F.col(b).alias("root")).dropna()))
    before, state = None, now.agg(*print_).first()
    while state[0] and state != before:
        now = _written(_round(now))
        before, state = state, now.agg(*print_).first()
    roots = now.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return now.select("node", F.col("root").alias("component")).unionByName(roots)
