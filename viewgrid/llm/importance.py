"""Importance resampling towards a target distribution over hashed n-grams (operator 12).

Features are words and pairs of neighbouring words (joined by one space), hashed by the
CRC-32 of their bytes to ``BUCKETS`` buckets.  CRC-32 is affine: the checksum of n
bytes is a constant of n, combined by exclusive-or with one contribution for each byte
that depends only on the byte and on its distance from the end.  A position table
holds the contributions up to a distance of ``REACH``, so the checksums of all
features of a run of documents are one table look-up and one
``bitwise_xor.reduceat`` over the feature spans.  Longer spans are folded: blocks of
``REACH`` bytes are looked up alike and joined pairwise, the left one shifted past the
right one, level by level.

1. Tasks add up a histogram of ``BUCKETS`` counts over all documents, and over the target.
2. A bucket's gain is the scaled logarithm of its smoothed target share over its
   smoothed corpus share; a document's weight is the floored mean gain of its features.
3. A Gumbel variate drawn from a hash of doc_id is added, and the highest scores
   are drawn: sampling without replacement in proportion to exp(weight / 1000).
   Ranks come from a range-partitioned sort and one count for each part.

Texts are read twice and never shuffled; what moves is a row of numbers for each document.

Defined results: a null or empty text has no features and the weight 0.  Rows
without doc_id have a weight, but no score, and are never drawn.  Repeated rows count
and are drawn each on their own, in any order among themselves.  Other columns are
ignored.  An empty target or corpus gives counts of zero, and all documents are returned.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.pieces import gather
from viewgrid.llm.tables import id_and_text, staged

BUCKETS = 10_000
REACH = 64  # bytes from the end of a span that the position table covers
SPAN_BYTES = 1 << 20  # of spans looked up at once
PERCENT = 25
LEAST_WORDS = 20
SEED = "7:"

POLYNOMIAL = 0xEDB88320  # CRC-32, reflected
_ALL = np.uint32(0xFFFFFFFF)

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False  # after lower-casing


def _advance(state: np.ndarray, step: np.ndarray) -> np.ndarray:
    """States behind one more zero byte."""
    return (state >> np.uint32(8)) ^ step[state & np.uint32(255)]


def position_table(reach: int = REACH) -> np.ndarray:
    """[distance from the end, byte]: what the byte adds to the checksum."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    rows = [state]
    for _ in range(reach - 1):
        rows.append(_advance(rows[-1], rows[0]))
    return np.array(rows)


TABLE = position_table()
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)  # of n zero bytes


def _shifted(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    """States behind as many zero bytes as ``tables`` (one for each byte of a state) stands for."""
    out = tables[0][state & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


_shifts = [np.array([TABLE[REACH - 1 - k] for k in range(4)])]  # past REACH, 2 REACH, 4 REACH ... bytes


def shift(level: int) -> np.ndarray:
    while len(_shifts) <= level:
        _shifts.append(np.array([_shifted(_shifts[-1], row) for row in _shifts[-1]]))
    return _shifts[level]


def _linear(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The contributions of the bytes of each span (1 to REACH bytes) together."""
    out = np.empty(len(starts), np.uint32)
    sizes = ends - starts
    total = np.cumsum(sizes)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SPAN_BYTES, side="right")))
        n = sizes[a:b]
        first = np.cumsum(n) - n
        back = np.repeat(first + n - 1, n) - np.arange(int(n.sum()))  # distance from the end
        at = np.repeat(ends[a:b] - 1, n) - back
        out[a:b] = np.bitwise_xor.reduceat(TABLE[back, buf[at]], first)
        a = b
    return out


def span_crcs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every byte span."""
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = (sizes > 0) & (sizes <= REACH)
    out[short] = _linear(buf, starts[short], ends[short]) ^ LENGTH[sizes[short]]
    for k in np.flatnonzero(sizes > REACH).tolist():
        a, b = int(starts[k]), int(ends[k])
        cuts = np.concatenate([[a], np.arange(b - (b - a - 1) // REACH * REACH, b + 1, REACH)])  # the first block may be short
        part = _linear(buf, cuts[:-1], cuts[1:])
        level = 0
        while len(part) > 1:
            if len(part) % 2:
                part = np.concatenate([np.zeros(1, np.uint32), part])  # zeros in front add nothing
            part = _shifted(shift(level), part[::2]) ^ part[1::2]
            level += 1
        out[k] = part[0] ^ np.uint32(zlib.crc32(bytes(b - a)))
    return out


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words; of all neighbours; which neighbours are of one document; index of each document's first word."""
    buf = ts.LOWER[buf]
    first, last, at = ts.words(buf, offs, _NOT_WORD)
    sizes = last - first
    ends = np.cumsum(sizes + 1) - 1  # in a buffer of all words with one space behind each
    starts = ends - sizes
    line = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    line[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = gather(buf, first, sizes)
    inside = np.ones(max(len(first) - 1, 0), bool)
    cut = at[1:-1]
    inside[cut[(cut > 0) & (cut < len(first))] - 1] = False
    pairs = np.zeros(len(inside), np.int64)
    pairs[inside] = span_crcs(line, starts[:-1][inside], ends[1:][inside]) % BUCKETS
    return (span_crcs(line, starts, ends) % BUCKETS).astype(np.int64), pairs, inside, at


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, buf, offs in ts.text_chunks(batch.column(0)):
            words, pairs, inside, _ = features(buf, offs)
            total += np.bincount(words, minlength=BUCKETS) + np.bincount(pairs[inside], minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def histogram(texts: DataFrame) -> np.ndarray:
    """Features of all ``texts`` in each bucket; at most BUCKETS rows reach the driver."""
    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_histogram, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000 * ln of each bucket's smoothed target share over its smoothed corpus share."""
    whole, wanted = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1.0) * whole / ((s + 1.0) * wanted))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int) -> int:
    """Floored 1000 * a Gumbel variate from a hash of doc_id."""
    h = int(hashlib.sha256(f"{SEED}{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(1)):
                words, pairs, inside, at = features(buf, offs)
                single = np.concatenate([[0], np.cumsum(gain[words])])
                double = np.concatenate([[0], np.cumsum(np.where(inside, gain[pairs], 0)), [0]])
                i, j = at[:-1], at[1:]
                n = np.maximum(2 * (j - i) - 1, 0)
                last = np.maximum(j - 1, i)  # pairs are counted by their first word
                total = single[j] - single[i] + np.where(j > i, double[last] - double[np.minimum(i, last)], 0)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                keys = batch.column(0).slice(a, b - a).to_pylist()
                score = [None if k is None else w + gumbel(k) for k, w in zip(keys, weight.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(j - i), pa.array(n), pa.array(weight), pa.array(score, pa.int64())],
                    ["doc_id", "n_words", "n_features", "weight", "score"],
                )

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``rows`` (with doc_id and score) with their rank, 1, 2, 3 ..., by falling score and rising doc_id; null beyond ``percent``.

    Equal rows are dealt over parts by their place, so no key has to fit in one task.  The
    running sum goes over one row for each part, and that table is the one broadcast.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc_id"), F.col("place")]
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("place", F.monotonically_increasing_id())  # part << 33 | index in the part
    dealt = staged(dealt.withColumn("part", F.shiftrightunsigned("place", 33)).withColumn("place", F.col("place").bitwiseAND((1 << 33) - 1)), "importance-order")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.col("base") + F.col("place") + 1
    most = percent * dealt.count() // 100
    return dealt.join(F.broadcast(counts), "part").select(*rows.columns, F.when(rank <= most, rank).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank and n_words of every row; see the module's text."""
    rows = staged(weighted(docs, gains(histogram(docs), histogram(target))), "importance-weights")
    able = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    out = drawn(rows.where(able), percent).unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def resampled_sql(docs: str, target: str, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> str:
    """DuckDB SQL for ``resampled``; the checksum is stated bit by bit from its definition."""
    byte = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
    WITH steps AS (SELECT list(r ORDER BY b) AS step FROM (SELECT b, {byte} AS r FROM range(256) t(b))),
    texts AS (
        SELECT row_number() OVER () AS row, src, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS words
        FROM (SELECT 's' AS src, doc_id, text FROM {docs} UNION ALL SELECT 't', item_id, text FROM {target})
    ), found AS (
        SELECT row, src, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM texts
    ), sums AS (
        SELECT feature,
               xor(4294967295, list_reduce(
                   list_transform(range(octet_length(encode(feature))), lambda i: ('0x' || substr(hex(encode(feature)), (2 * i + 1)::INTEGER, 2))::BIGINT),
                   lambda c, x: xor(c // 256, step[(xor(c, x) & 255) + 1]), 4294967295)) % {BUCKETS} AS bucket
        FROM (SELECT DISTINCT feature FROM found), steps
    ), counts AS (
        SELECT bucket, count(*) FILTER (src = 's') AS s, count(*) FILTER (src = 't') AS t FROM found JOIN sums USING (feature) GROUP BY bucket
    ), totals AS (SELECT sum(s) AS s, sum(t) AS t FROM counts),
    gain AS (
        SELECT bucket, floor(1000 * ln((c.t + 1)::DOUBLE * (totals.s + {BUCKETS})::DOUBLE / ((c.s + 1)::DOUBLE * (totals.t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
        FROM counts c, totals
    ), weights AS (
        SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
        FROM found JOIN sums USING (feature) JOIN gain USING (bucket) WHERE src = 's' GROUP BY row
    ), scored AS (
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(words)::BIGINT AS n_words,
               coalesce(weight, 0)::BIGINT
               + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM texts LEFT JOIN weights USING (row) WHERE src = 's'
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY n_words >= {least_words} ORDER BY score DESC, doc_id) AS rank,
               count(*) OVER (PARTITION BY n_words >= {least_words}) AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {least_words} AND rank <= {percent} * n // 100 THEN rank END::BIGINT AS rank, n_words
    FROM ranked
    """
