"""Benchmark items inside documents, by size-partitioned MinHash containment search (operator 8).

A short item inside a long document has next to no Jaccard similarity with the
whole of it.  So items are partitioned by size (powers of two), and for a
partition of at most u shingles a document counts as overlapping segments of 2 u
shingles, u apart: any run of u shingles lies whole in one of them, and an item
of the partition that a segment contains by 80 % has a similarity of 0.19 or more with it.

Signatures are one-permutation MinHash: the least hash of each of ``BINS`` bins.
A segment and an item are candidates when a bin has the same least hash in
both.  The index holds the signatures of the items; a segment's signature is
only worked out in the bins where one of its shingles is in the index, as no
other bin can agree.

Candidates are verified by exact containment: 100 * (item's shingles in the whole
document) >= ``PERCENT`` * (item's shingles).

Items are the query set: they go out in blocks of at most ``BLOCK_ITEMS`` items and
about ``BLOCK_BYTES`` of text, each broadcast, against all documents.  Nothing is shuffled.

Defined results: words are lower-cased (A-Z).  A text with fewer than five words
has its whole word sequence as one shingle; one without words (null, empty) has
none, and is neither found nor contaminated.  Items or documents without an id
are treated like others and carry a null.  Repeated items and documents give a
row for each pair of rows.  Other columns are ignored (search) or kept (clean).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.pieces import gather
from viewgrid.llm.tables import id_and_text

SHINGLE = 5
PERCENT = 80
BIN_BITS = 8  # 256 bins
BIN_SHIFT = ts.U(64 - BIN_BITS)
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20

FOUND = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def sequence(w: np.ndarray, a: int, b: int, g: np.ndarray) -> np.ndarray:
    """Shingle hashes of the words a to b, in order."""
    if b - a >= SHINGLE:
        return g[a : b - SHINGLE + 1]
    return run_of_all(w[a:b])


def run_of_all(w: np.ndarray) -> np.ndarray:
    return ts.run_hashes(w, len(w)) if len(w) else np.empty(0, ts.U)


def among(values: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which of ``g`` are in the sorted ``values``."""
    if not len(values):
        return np.zeros(len(g), bool)
    return values[np.minimum(np.searchsorted(values, g), len(values) - 1)] == g


def place(cells: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Place of each ``cell`` in the sorted ``cells``; -1 if it isn't there."""
    return np.where(among(cells, cell), np.searchsorted(cells, cell), -1)


class Index:
    """Signatures and shingle sets of a block of items."""

    def __init__(self, ids: list, texts: list):
        self.ids, sets = [], []
        for a, b, buf, offs in ts.text_chunks(pa.array(texts, pa.string())):
            flat, at = ts.shingle_sets(buf, offs, SHINGLE)
            for k in range(b - a):
                if at[k + 1] > at[k]:
                    self.ids.append(ids[a + k])
                    sets.append(flat[at[k] : at[k + 1]])
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.ends = np.cumsum(self.sizes)
        self.flat = np.concatenate(sets) if sets else np.empty(0, ts.U)
        # sets are sorted: the first shingle of each bin is its least
        item = np.repeat(np.arange(len(sets)), self.sizes)
        bins = self.flat >> BIN_SHIFT
        least = np.ones(len(self.flat), bool)
        least[1:] = (bins[1:] != bins[:-1]) | (item[1:] != item[:-1])
        value, item = self.flat[least], item[least]
        order = np.argsort(value, kind="stable")
        value, item = value[order], item[order]
        self.value = value[np.concatenate([[True], value[1:] != value[:-1]])] if len(value) else value
        exponent = np.frexp((self.sizes - 1).astype(float))[1]  # sizes up to 2**exponent
        self.units = [(1 << e, value[exponent[item] == e], item[exponent[item] == e]) for e in np.unique(exponent).tolist()]

    def candidates(self, g: np.ndarray) -> np.ndarray:
        """Items of which some signature value is the least of its bin in a segment of the document too.

        Whether a shingle is the least of its bin depends on the place and the size of the
        segment, not on the item: it is settled once for all items of a size.
        """
        hit = np.flatnonzero(among(self.value, g))
        bins = (g >> BIN_SHIFT).astype(np.int64)
        asked = np.zeros(1 << BIN_BITS, bool)
        asked[bins[hit]] = True
        rivals = np.flatnonzero(asked[bins])  # other bins have no say
        found = [np.empty(0, np.int64)]
        for unit, value, item in self.units:
            own = hit[among(value, g[hit])]
            if not len(own):
                continue
            cells, at = np.unique((rivals // unit << BIN_BITS) + bins[rivals], return_inverse=True)
            least = np.full(len(cells) + 1, np.iinfo(ts.U).max, ts.U)  # the last: of a cell without shingles
            np.minimum.at(least, at, g[rivals])
            cell = (own // unit << BIN_BITS) + bins[own]
            before, here, after = (least[place(cells, cell + (d << BIN_BITS))] for d in (-1, 0, 1))
            v = g[own]
            good = np.unique(v[(here == v) & ((before >= v) | (after >= v))])
            first = np.searchsorted(value, good)
            found.append(gather(item, first, np.searchsorted(value, good, side="right") - first))
        return np.unique(np.concatenate(found))

    def shared(self, items: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """How many shingles of each item are in the sorted set ``whole``."""
        sizes = self.sizes[items]
        inside = np.concatenate([[0], np.cumsum(among(whole, gather(self.flat, self.ends[items] - sizes, sizes)))])
        ends = np.cumsum(sizes)
        return inside[ends] - inside[ends - sizes]

    def matches(self, buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document index, item index, shared shingles) of every verified pair."""
        w, at = ts.word_hashes(buf, offs, lower=True)
        g = ts.run_hashes(w, SHINGLE)
        inside = np.concatenate([[0], np.cumsum(among(self.value, g))])
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if b - a >= SHINGLE and inside[b - SHINGLE + 1] == inside[a]:
                continue  # no shingle of the document is in the index
            own = sequence(w, a, b, g)
            items = self.candidates(own)
            if len(items):
                n = self.shared(items, np.unique(own))
                held = 100 * n >= PERCENT * self.sizes[items]
                for item, m in zip(items[held].tolist(), n[held].tolist()):
                    yield k, item, m


def blocks(items: DataFrame) -> Iterator[Index]:
    """Indexes of all items (item_id, text), a bounded block at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.length("text") > 0)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(parts):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()  # bounded by the block
        part.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        yield Index([r.item_id for r in part], [r.text for r in part])


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_shared and containment of every document that holds an item."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], FOUND)
    for index in blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                keys = batch.column(0).to_pylist()
                for a, _, buf, offs in ts.text_chunks(batch.column(1)):
                    rows = [(keys[a + k], ix.ids[i], int(ix.sizes[i]), n, n / int(ix.sizes[i])) for k, i, n in ix.matches(buf, offs)]
                    columns = list(zip(*rows)) or [()] * 5
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

        out = out.unionByName(id_and_text(docs).mapInArrow(run, FOUND))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    spark = docs.sparkSession
    docs = docs.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")
    for index in blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, _, buf, offs in ts.text_chunks(batch.column(at)):
                    keep[[a + k for k, _, _ in shared.value.matches(buf, offs)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
