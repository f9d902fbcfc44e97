"""Placement of documents on shards by a permutation-filled lookup table (operator 1).

Every shard has its own preference order over the slots of a table of prime
size: slot (offset + j * skip) mod size, from hashes of its name.  Shards take
turns; each turn claims the first slot of its order that is still free.  A key's
slot is its hash modulo the size, so placement is one lookup in a broadcast
table whose size is fixed by the number of shards, whatever the input.  Shares
are even to about 1 in ``SLOTS_PER_SHARD``, and when a shard comes or goes few
other keys move.

Hashes are the first 15 hexadecimal digits of md5, so any engine can repeat them.

Defined results: a null key is placed as the empty text; equal keys share a
shard.  Columns named slot or shard (any case) are replaced; all others and all
rows stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100


def text_hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def table_size(shards: int) -> int:
    """The least prime of at least SLOTS_PER_SHARD slots for each shard."""
    n = max(3, SLOTS_PER_SHARD * shards)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: Sequence[str], size: int | None = None) -> list[int]:
    """For each slot, the index of its shard."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be some distinct names")
    size = size or table_size(len(shards))
    offset = [text_hash(s + "/offset") % size for s in shards]
    skip = [text_hash(s + "/skip") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    at = [0] * len(shards)
    for turn in range(size):
        k = turn % len(shards)
        slot = (offset[k] + at[k] * skip[k]) % size
        while owner[slot] >= 0:
            at[k] += 1
            slot = (offset[k] + at[k] * skip[k]) % size
        owner[slot] = k
    return owner


def slot_of(key: Column, size: int) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def placed(df: DataFrame, key: str, shards: Sequence[str]) -> DataFrame:
    """``df`` with slot (int) and shard (int, index into ``shards``)."""
    owner = lookup_table(shards)
    table = df.sparkSession.createDataFrame(list(enumerate(owner)), "slot int, shard int")
    rest = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    keyed = df.select(*(F.col(f"`{c}`") for c in rest), slot_of(F.col(f"`{key}`"), len(owner)).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select(*(F.col(f"`{c}`") for c in rest), "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: Sequence[str], path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet folder with one folder for each shard; large shards are written by several tasks as several files."""
    rows = placed(df, key, shards)
    rows.hint("rebalance", "shard").write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("shard") == shard)


def placement_sql(docs: str, key: str, shards: Sequence[str]) -> str:
    """DuckDB SQL for ``placed`` over table ``docs``: turns are steps of a recursion over the table as a list."""
    size, n = table_size(len(shards)), len(shards)
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))
    return f"""
        WITH RECURSIVE shards(k, name) AS (VALUES {names}),
        prefs AS (
            SELECT list(('0x' || substr(md5(name || '/offset'), 1, 15))::BIGINT % {size} ORDER BY k) AS offsets,
                   list(('0x' || substr(md5(name || '/skip'), 1, 15))::BIGINT % {size - 1} + 1 ORDER BY k) AS skips
            FROM shards),
        turns(turn, owner) USING KEY (key_) AS (
            SELECT 0, list_transform(range({size}), lambda x: -1), 0 AS key_
            UNION
            SELECT turn + 1,
                   list_transform(owner, lambda x, i: CASE WHEN i - 1 = slot THEN turn % {n} ELSE x END), 0
            FROM (SELECT turn, owner,
                         list_filter(list_transform(range({size}), lambda j: (offsets[turn % {n} + 1] + j * skips[turn % {n} + 1]) % {size}),
                                     lambda s: owner[s + 1] = -1)[1] AS slot
                  FROM turns, prefs WHERE turn < {size})),
        placed AS (
            SELECT {key}, (('0x' || substr(md5(coalesce({key}::VARCHAR, '')), 1, 15))::BIGINT % {size})::INT AS slot FROM {docs})
        SELECT p.{key}, p.slot, t.owner[p.slot + 1]::INT AS shard FROM placed p, turns t
    """
