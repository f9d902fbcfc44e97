"""Connected components of a table of links, by alternating large and small stars.

Union-find as joins: in a round every node's larger neighbours are linked to its
least neighbour, then every node's smaller neighbours to the least of them,
until nothing changes.  Each round is written to the shared folder, so lineage
stays short.  The minimum of a hot node is pre-aggregated, and its links are an
ordinary join side that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.llm.tables import staged


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _ordered(e: DataFrame) -> DataFrame:
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every end of a link (columns u, v): the least node that it reaches."""
    e = staged(_ordered(links), "components")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = _ordered(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(_ordered(small.unionByName(least.select("u", F.col("m").alias("v")))), "components")
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
