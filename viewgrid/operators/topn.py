"""Top-1 per key as a hash aggregate instead of a window.

``row_number() OVER (PARTITION BY k ORDER BY o) = 1`` sends every row of a key
to one task and sorts it; a hot key (say a third of all rows) then becomes one
huge task.  ``min_by(struct(values), struct(order))`` is a declarative
aggregate: each map task keeps one candidate per key (partial aggregation), so
the shuffle carries one row per key per task and skew costs nothing.

Ordering keys are structs compared field by field with NULL smallest, i.e.
ascending NULLS FIRST for ``first_by`` and descending NULLS LAST for
``last_by`` -- Spark's defaults for ASC / DESC in ORDER BY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[str], values: list[str],
             extra_aggs: list | None = None) -> DataFrame:
    """One row per ``keys``: ``values`` of the row with the smallest ``order``."""
    best = F.min_by(F.struct(*values), F.struct(*order)).alias("__best")
    out = df.groupBy(*keys).agg(best, *(extra_aggs or []))
    return out.select(*keys, *[F.col(f"__best.{v}").alias(v) for v in values],
                      *[c for c in out.columns if c not in keys and c != "__best"])


def last_by(df: DataFrame, keys: list[str], order: list[str], values: list[str],
            extra_aggs: list | None = None) -> DataFrame:
    """One row per ``keys``: ``values`` of the row with the largest ``order``."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("__best")
    out = df.groupBy(*keys).agg(best, *(extra_aggs or []))
    return out.select(*keys, *[F.col(f"__best.{v}").alias(v) for v in values],
                      *[c for c in out.columns if c not in keys and c != "__best"])
