"""Aggregate building blocks.

All of them are partial-aggregation friendly: a hot group key is pre-combined
inside each map task, so no task ever holds more than one value set per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def str_list(c) -> Column:
    """Sorted distinct values joined by ',' -- NULL when every value is NULL.

    Equivalent to string_agg(DISTINCT c, ',') with a fixed (sorted) order.
    collect_set is an ObjectHashAggregate with partial aggregation, and unlike
    several DISTINCT aggregates in one query it plans no Expand.
    """
    s = F.collect_set(_c(c))
    return F.when(F.size(s) > 0, F.array_join(F.array_sort(s), ","))


def flat_list(c, sep: str = ",") -> Column:
    """Distinct tokens of a separated-list column, sorted, joined by ','.

    '' (not NULL) when every value is NULL.  The per-group buffer is the set of
    distinct *lists*, so it is bounded by distinct values, not by row count.
    """
    lists = F.collect_set(F.split(_c(c), sep))
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(lists))), ",")


def sorted_set(c) -> Column:
    """collect_set as a sorted array (deterministic output)."""
    return F.array_sort(F.collect_set(_c(c)))


def count_maps(df: DataFrame, keys: list[str], categories: dict[str, Column],
               value_name: str = "sessions") -> DataFrame:
    """One map<category, count> column per category family, in one pass.

    ``categories`` maps output column -> expression yielding either a string
    (one category per row) or an array<string> (several, e.g. genre tokens;
    repeated tokens count repeatedly).  Rows are tagged and exploded once,
    counted per (keys, family, category) with partial aggregation, then folded
    into maps per key -- instead of one group-by and one join per family.
    Families with no rows in a group come out as NULL maps only when the group
    has no rows at all (every family yields a category for every row).
    """
    exploded = df.select(*keys, F.explode(_tagged(df, categories)).alias("t"))
    counted = (exploded.groupBy(*keys, F.col("t.f").alias("f"), F.col("t.k").alias("k"))
               .agg(F.count(F.lit(1)).alias("v")))
    # one list per group (not one per family: partial buffers would carry the
    # empty lists of the other families), split into the maps afterwards
    grouped = counted.groupBy(*keys).agg(F.collect_list(F.struct("f", "k", "v")).alias("__e"))
    return grouped.select(*keys, *[_family_map(i).alias(name) for i, name in enumerate(categories)])


def _family_map(i: int) -> Column:
    only = F.filter(F.col("__e"), lambda e: e["f"] == i)
    return F.map_from_entries(F.transform(only, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))


def count_entries(df: DataFrame, keys: list[str], categories: dict[str, Column],
                  family_name: str = "category_type", key_name: str = "category",
                  value_name: str = "sessions") -> DataFrame:
    """Long form of ``count_maps``: (keys, family, category, count) rows."""
    exploded = df.select(*keys, F.explode(_tagged(df, categories)).alias("t"))
    counted = (exploded.groupBy(*keys, F.col("t.f").alias("__f"), F.col("t.k").alias(key_name))
               .agg(F.count(F.lit(1)).alias(value_name)))
    names = F.array(*[F.lit(n) for n in categories])
    return counted.select(*keys, F.element_at(names, F.col("__f").cast("int") + 1).alias(family_name),
                          key_name, value_name)


def _tag(i: int):
    return lambda x: F.struct(F.lit(i).cast("tinyint").alias("f"), x.alias("k"))


def _tagged(df: DataFrame, categories: dict[str, Column]) -> Column:
    """array<struct<f: family index, k: category>> for one row, all families.

    The family travels through the shuffles as a one-byte index, not its
    name; names are attached after aggregation.
    """
    parts = []
    for i, expr in enumerate(categories.values()):
        arr = expr if _is_array(df, expr) else F.array(expr)
        parts.append(F.transform(arr, _tag(i)))
    return F.concat(*parts)


def _is_array(df: DataFrame, expr: Column) -> bool:
    from pyspark.sql.types import ArrayType
    return isinstance(df.select(expr).schema.fields[0].dataType, ArrayType)
