"""Enrichment joins (fact LEFT JOIN mapping table).

Every join in the models is a left outer equi-join of a large fact table with
a mapping table.  Two sizes of mapping table exist:

* dimension-sized (genre per episode, category per creative, population per
  market): broadcast, but only after proving the row count is below a bound;
  beyond the bound the plain join stays and AQE picks the strategy. ``left_enrich``
  there deals the rows of large inputs over more tasks (``dealt_join``).
* device-sized (time zone per device, attributes per device): where the fact
  rows are wide (the detail models' time zones), broadcast within tighter
  bounds, so that the wide rows aren't shuffled; elsewhere, and beyond the bounds, never hinted.
  AQE then broadcasts it at runtime if it turns out small, otherwise it is a
  sort-merge join whose skewed (hot-device) partitions AQE splits.

Duplicate keys in a mapping table fan fact rows out, as in the reference; use
``operators.quality.duplicate_keys`` to check a mapping before relying on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.operators.sizes import input_bytes

# A mapping table is broadcast only when it provably has at most this many
# rows AND this many bytes of payload (measured, not estimated).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
# The same for a map with a row per device.
DEVICE_BROADCAST_ROWS = 1_000_000
DEVICE_BROADCAST_BYTES = 32 * 1024 * 1024
# Input files' bytes for as many partitions more as Spark has for a shuffle, when rows are joined with a map beyond its
# bounds; the most of such partitions; and over how many of them the rows of one key are spread.
JOIN_BYTES = 64 * 1024 * 1024
MAX_JOIN_PARTITIONS = 192
KEY_SPREAD = 4

_FIXED_WIDTH = {"ByteType": 1, "ShortType": 2, "IntegerType": 4, "DateType": 4, "FloatType": 4,
                "BooleanType": 1}


def _row_bytes(df: DataFrame):
    """Column expression: payload bytes of one row (strings/binary by their
    actual length, fixed-width types by their width, others 8 bytes)."""
    parts = []
    for f in df.schema.fields:
        t = type(f.dataType).__name__
        if t in ("StringType", "BinaryType", "VarcharType", "CharType"):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(t, 8)))
    expr = parts[0]
    for p in parts[1:]:
        expr = expr + p
    return expr.cast("long")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if ``df`` provably has at most ``max_rows`` rows and
    ``max_bytes`` payload bytes; otherwise ``df`` unchanged.

    One job: row count and summed row bytes, partially aggregated in every
    task.  Beyond the bound the join is planned from size statistics / AQE
    (sort-merge, with skew splitting).
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    n, b = r["n"], r["b"] or 0
    return F.broadcast(df) if n <= max_rows and b <= max_bytes else df


def join_partitions(fact: DataFrame) -> int:
    """Partitions for the shuffle of ``fact``, so that a task's share doesn't grow with the files behind it."""
    own = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(own, MAX_JOIN_PARTITIONS)
    return min(most, own * (1 + input_bytes(fact, JOIN_BYTES * most) // JOIN_BYTES))


def dealt_join(fact: DataFrame, m: DataFrame, fact_key: str, spread_by=()) -> DataFrame:
    """fact LEFT JOIN m ON fact_key = __k, by a shuffle that is sized to the input.

    AQE doesn't split the partitions of a shuffle with a given number, so a key's rows go by
    ``spread_by`` (default: the whole row) to ``KEY_SPREAD`` places, each with the key's rows of ``m``; rows without
    a key match nothing and go anywhere. Where Spark's own number is more than half as large, the join is left to AQE.
    """
    n = join_partitions(fact)
    if n < 2 * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return fact.join(m, fact[fact_key] == m["__k"], "left").drop("__k")
    row = F.xxhash64(*(spread_by or [f.name for f in fact.schema.fields if "map<" not in f.dataType.simpleString()]))  # maps cannot be hashed
    place = F.when(F.col(fact_key).isNull(), row).otherwise(F.pmod(row, F.lit(KEY_SPREAD)))
    f = fact.withColumn("__place", place).repartition(n, fact_key, "__place")
    places = F.explode(F.array(*[F.lit(i).cast("long") for i in range(KEY_SPREAD)]))
    m = m.withColumn("__at", places).repartition(n, "__k", "__at")
    return f.join(m, (f[fact_key] == m["__k"]) & (f["__place"] == m["__at"]), "left").drop("__k", "__place", "__at")


def left_enrich(fact: DataFrame, mapping: DataFrame, fact_key: str, map_key: str,
                columns: dict[str, str], small: bool = False,
                max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES, spread_by=()) -> DataFrame:
    """fact LEFT JOIN mapping ON fact_key = map_key, adding ``columns``.

    ``columns`` maps mapping-table column -> output name.  ``small`` marks a
    dimension-sized mapping eligible for a size-checked broadcast; beyond its bounds
    ``spread_by`` are the columns that tell a key's rows apart (``dealt_join``).
    """
    m = mapping.select(F.col(map_key).alias("__k"),
                       *[F.col(src).alias(dst) for src, dst in columns.items()])
    if small:
        bounded = bounded_broadcast(m, max_rows, max_bytes)
        if bounded is m:  # beyond its bounds
            return dealt_join(fact, m, fact_key, spread_by)
        m = bounded
    return fact.join(m, fact[fact_key] == m["__k"], "left").drop("__k")


def with_timezone(fact: DataFrame, tz_map: DataFrame) -> DataFrame:
    """Wide ``fact`` rows with the TIMEZONE of their device (``hash``); the map is broadcast within the device bounds."""
    return left_enrich(fact, tz_map, "hash", "hash", {"timezone": "TIMEZONE"}, small=True,
                       max_rows=DEVICE_BROADCAST_ROWS, max_bytes=DEVICE_BROADCAST_BYTES, spread_by=("ts_start",))
