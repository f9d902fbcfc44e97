"""Hard negatives by Strassen products of integer tiles and mergeable heaps (operator 11).

Components become integers, floor(``SCALE`` * x), and scores are inner products of
them.  Anchors are the query set: they go out in blocks of at most ``BLOCK_BYTES``,
each broadcast, against all rows where they lie; no vector is shuffled.  A task cuts its
rows into tiles, multiplies anchor tile by row tile with Strassen's recursion (seven
half-size products, odd sides padded with zeros) and keeps heaps of bounded size:

1. Positives: the first rows of the anchor's own label.  Only tiles of one label
   are multiplied.
2. Windows: for each positive the first rows of other labels whose score lies in
   its window.

Heaps of different tasks merge in a shuffle of at most ``keep`` rows a task and heap.
A block's result is written before the next block goes out.

int64 arithmetic is a ring modulo 2**64, so the recursion's sums may wrap and the
products are still exact, as long as scores themselves fit.  Components that could lead
to scores beyond 2**56 are an error.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part.  Vectors of different lengths are compared as if padded
with zeros.  Anchors equal in id, label and vector are one anchor.  Rows with
the anchor's id are never its candidates.  In one list a pair of score and id
counts once, so repeated rows don't fill it.  A negative positive score has an
empty window.  Other columns are ignored; no anchors or rows: no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewgrid.llm.tables import staged

SCALE = 256
KEEP = 5  # positives of an anchor, and negatives of a positive
LOW, HIGH = 80, 100  # the window, in per cent of the positive's score
LEAF = 32  # sides up to this are multiplied plainly
TILE_ANCHORS, TILE_CELLS = 512, 1 << 17
BLOCK_BYTES = 8 << 20
_LEAST = np.iinfo(np.int64).min
_MOST_SCORE = 1 << 56

PAIRS = "slot long, score long, vec_id long"
FOUND = "slot long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for int64 matrices, modulo 2**64; in doubles where all sums stay below 2**53 and so are exact."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for int64 matrices, modulo 2**64."""
    if min(*a.shape, b.shape[1]) <= LEAF:
        return leaf(a, b)
    m, d, n = *a.shape, b.shape[1]
    a, b = np.pad(a, ((0, m % 2), (0, d % 2))), np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    out = np.empty((2 * i, 2 * j), np.int64)
    c11, c12, c21, c22 = out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:]
    both = strassen(a11 + a22, b11 + b22)
    c11[:], c22[:] = both, both
    part = strassen(a21 + a22, b11)
    c21[:] = part
    c22 -= part
    part = strassen(a11, b12 - b22)
    c12[:] = part
    c22 += part
    part = strassen(a22, b21 - b11)
    c11 += part
    c21 += part
    part = strassen(a11 + a12, b22)
    c11 -= part
    c12 += part
    c22 += strassen(a21 - a11, b11 + b12)
    c11 += strassen(a12 - a22, b21 + b22)
    return out[:m, :n]


class Heaps:
    """The first ``keep`` (score, id) pairs of every slot: higher scores first, then smaller ids; equal pairs count once."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.slot, self.score, self.key = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(slots, _LEAST)  # the last score of a full slot: lower ones can't get in

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        slot, score, key = (np.concatenate(c) for c in zip((self.slot, self.score, self.key), (slot, score, key)))
        order = np.lexsort((key, ~score, slot))
        slot, score, key = slot[order], score[order], key[order]
        if len(slot):
            same = (slot[1:] == slot[:-1]) & (score[1:] == score[:-1]) & (key[1:] == key[:-1])
            new = np.concatenate([[True], ~same])
            slot, score, key = slot[new], score[new], key[new]
            first = np.concatenate([[True], slot[1:] != slot[:-1]])
            rank = np.arange(len(slot)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            kept = rank < self.keep
            last = rank == self.keep - 1
            self.least[slot[last]] = score[last]
            slot, score, key = slot[kept], score[kept], key[kept]
        self.slot, self.score, self.key = slot, score, key

    def offer(self, slots: np.ndarray, scores: np.ndarray, keys: np.ndarray, distinct: bool) -> None:
        """Add a tile: a row of scores for each of ``slots`` (``_LEAST``: no candidate), a column for each key."""
        bar = self.least[slots]
        if distinct and scores.shape[1] > 4 * self.keep:  # no repeated key can take two of the first places
            bar = np.maximum(bar, np.partition(scores, -self.keep, axis=1)[:, -self.keep])
        r, c = np.nonzero((scores >= bar[:, None]) & (scores != _LEAST))
        if len(r):
            self.add(slots[r], scores[r, c], keys[c])


def integers(rows: pa.RecordBatch | pa.Table, a: int, b: int) -> np.ndarray:
    """Rows a to b of column ``vec`` as an int64 matrix, short ones padded with zeros."""
    part = rows.column("vec").slice(a, b - a)
    part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
    sizes = part.value_lengths().to_numpy()
    out = np.zeros((len(part), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = part.flatten().to_numpy()
    out = np.floor(SCALE * out)
    most = np.abs(out).max(initial=0)
    if most * most * max(out.shape[1], 1) >= _MOST_SCORE:
        raise ValueError(f"a component of about {most / SCALE:.3g} is too large for exact 64-bit scores")
    return out.astype(np.int64)


@dataclass
class Anchors:
    """A block of anchors, and the positives found for them."""

    key: np.ndarray
    label: np.ndarray
    vec: np.ndarray
    of: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # the anchor of each positive
    positive: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def tiles(self, rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, labels and integer vectors of the batch, a bounded number of cells at a time."""
        key, label = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        width = int(rows.column("vec").value_lengths().to_numpy().max(initial=1)) if rows.num_rows else 1
        step = max(1, TILE_CELLS // max(width, 1))
        for a in range(0, rows.num_rows, step):
            b = min(a + step, rows.num_rows)
            yield key[a:b], label[a:b], integers(rows, a, b)

    def scores(self, own: np.ndarray, vec: np.ndarray) -> np.ndarray:
        """Scores of the anchors ``own`` against the rows ``vec``; both are padded to one width."""
        left, width = self.vec[own], max(self.vec.shape[1], vec.shape[1])
        left, right = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (left, vec))
        return strassen(left, np.ascontiguousarray(right.T))


def _positives(block, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = block.value
        heaps = Heaps(len(anchors.key), keep)
        for batch in batches:
            for key, label, vec in anchors.tiles(batch):
                distinct = len(np.unique(key)) == len(key)
                for name in np.intersect1d(label, anchors.label).tolist():
                    rows, of = np.flatnonzero(label == name), np.flatnonzero(anchors.label == name)
                    for k in range(0, len(of), TILE_ANCHORS):
                        own = of[k : k + TILE_ANCHORS]
                        s = anchors.scores(own, vec[rows])
                        s[anchors.key[own][:, None] == key[rows]] = _LEAST
                        heaps.offer(own, s, key[rows], distinct)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (heaps.slot, heaps.score, heaps.key)], ["slot", "score", "vec_id"])

    return run


def _windows(block, keep: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = block.value
        heaps = Heaps(len(anchors.of), keep)
        first = np.searchsorted(anchors.of, np.arange(len(anchors.key) + 1))  # ``of`` is sorted
        most = int(np.diff(first).max(initial=0))
        bottom, top = -((-low * anchors.score) // 100), (high * anchors.score) // 100
        for batch in batches:
            for key, label, vec in anchors.tiles(batch):
                distinct = len(np.unique(key)) == len(key)
                for k in range(0, len(anchors.key), TILE_ANCHORS):
                    own = np.arange(k, min(k + TILE_ANCHORS, len(anchors.key)))
                    s = anchors.scores(own, vec)
                    s[(anchors.label[own][:, None] == label) | (anchors.key[own][:, None] == key)] = _LEAST
                    for j in range(most):
                        have = np.flatnonzero(first[own] + j < first[own + 1])
                        slot = first[own[have]] + j
                        inside = (s[have] >= bottom[slot][:, None]) & (s[have] <= top[slot][:, None])
                        some = inside.any(axis=1)
                        if some.any():
                            heaps.offer(slot[some], np.where(inside[some], s[have[some]], _LEAST), key, distinct)
        of = anchors.of[heaps.slot]
        columns = (heaps.slot, anchors.key[of], anchors.positive[heaps.slot], anchors.score[heaps.slot], heaps.key, heaps.score)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], FOUND.replace(" long", "").split(", "))

    return run


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label and vec (double components) of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)


def blocks(anchors: DataFrame, block_bytes: int) -> Iterator[Anchors]:
    """All anchors, a block of about ``block_bytes`` at a time."""
    n, width = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    parts = -(-n * max(width, 1) * 8 // block_bytes)
    for k in range(parts):
        rows = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(parts)) == k).toArrow()  # bounded by the block
        if rows.num_rows:
            yield Anchors(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), integers(rows, 0, rows.num_rows))


def _first(rows: DataFrame, score: str, key: str, keep: int) -> DataFrame:
    """The first ``keep`` of each slot and their rank; equal rows count once."""
    order = Window.partitionBy("slot").orderBy(F.col(score).desc(), key)
    return rows.repartition("slot").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mined(
    rows: DataFrame, anchor: Column, positives: int = KEEP, negatives: int = KEEP, low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the anchors among ``rows``.

    ``rows`` has vec_id, label and embedding; ``anchor`` is a condition on vec_id and label.  A positive's
    negatives satisfy low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = rows.sparkSession
    have = usable(rows)
    queries = staged(have.where(anchor).distinct(), "hard-anchors")
    out = None
    for block in blocks(queries, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        found = _first(have.mapInArrow(_positives(shared, positives), PAIRS), "score", "vec_id", positives)
        found = found.orderBy("slot", "rank").toArrow()  # at most ``positives`` rows for each anchor of the block
        shared.unpersist()
        block.of, block.positive, block.score = (found.column(c).to_numpy() for c in ("slot", "vec_id", "score"))
        shared = spark.sparkContext.broadcast(block)
        done = _first(have.mapInArrow(_windows(shared, negatives, low, high), FOUND), "negative_score", "negative_id", negatives)
        done = staged(done.select(*MINED.replace(" long", "").replace(" int", "").split(", ")), "hard-negatives")
        shared.unpersist()
        out = done if out is None else out.unionByName(done)
    return spark.createDataFrame([], MINED) if out is None else out


def mined_sql(table: str, label: str, anchor: str, keep: int = KEEP, low: int = LOW, high: int = HIGH) -> str:
    """DuckDB SQL for ``mined`` over a table with distinct vec_ids; ``label`` and ``anchor`` are expressions."""
    return f"""
    WITH rows AS (
        SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS vec
        FROM {table}
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scores AS (
        SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, list_inner_product(a.vec, r.vec)::BIGINT AS score
        FROM (SELECT * FROM rows WHERE {anchor}) a JOIN rows r ON a.vec_id <> r.vec_id
    ), positives AS (
        SELECT anchor_id, vec_id, score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {keep}
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
           s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM positives p
    JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same AND {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score
    QUALIFY rank <= {keep}
    """
