"""Near-duplicate groups by SuperMinHash, banding, verification and union-find (operator 7).

Signatures: each shingle draws its own random permutation of the ``SLOTS`` slots
and a fraction for each rank; a slot keeps the least rank + fraction of all
shingles.  The ranks of one shingle are all different, which makes the estimate
less noisy than independent hashes.  Ranks are dealt level by level, and a
document stops as soon as no later rank can lower any slot.

Candidates: documents of one shingle set are one text class, represented by the
row with the smallest doc_id (and, of rows that share it, the smallest text hash).  ``DRAWS`` independent signatures are kept, a byte for each slot.
A band is a few slots of the first one, and a bucket is a band with equal
bytes.  ``bounds`` derives the bands from the similarity that makes a link: texts of
just that similarity share no bucket with a probability of at most ``MISS``.

Verification, on full shingle sets, in two rounds:
1. Each class is compared with the smallest class of all its buckets.
2. Buckets that still hold several components are searched whole: pairs from
   different components whose signatures agree in enough slots (``bounds``: a link
   agrees less with a probability of at most ``MISS``) are compared, each pair in the
   first band it shares.  A large bucket is dealt out as pairs of blocks, so it has no
   limit and no single task.  A component of more than a block has blocks of its own, which are
   only set against blocks of other components; the rest share blocks.
Links found are joined to components; pairs inside a component are never made.

Defined results: documents without words (null, empty) link with nothing.  Rows that share
a doc_id and differ in text are documents of their own and may belong to different
components; rows that repeat doc_id and text are one document and repeat the result.
Rows without doc_id take no part: component_id null, kept true.  Other columns
are ignored (groups) or kept in their order (one_of_each).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.components import components
from viewgrid.llm.tables import bounded, staged

SLOTS = 250
DRAWS = 2
WIDTH = SLOTS * DRAWS
MOST_ROWS = 5  # slots of a band; the bytes of more don't fit its key
MISS = 6.5e-7  # probability that a link of the least similarity is missed, by the bands and again by the agreement bound
BLOCK = 2048  # texts of a bucket compared with as many others in one task
_NONE = np.iinfo(np.uint64).max
_ONE = ts.U(1) << ts.U(32)


class Bounds(NamedTuple):
    rows: int  # slots of a band
    bands: int
    agree: int  # slots of all WIDTH that agree at least


def bounds(percent: int) -> Bounds:
    """Bands and agreement bound for links of a similarity of ``percent`` or more."""
    s = percent / 100
    if s >= 1:
        return Bounds(MOST_ROWS, 1, WIDTH)
    for rows in range(MOST_ROWS, 0, -1):  # the more rows, the fewer pairs that are no links
        bands = math.ceil(math.log(MISS) / math.log1p(-(s**rows))) if s > 0 else SLOTS + 1
        if bands * rows <= SLOTS:
            break
    else:
        raise ValueError(f"{SLOTS} slots are too few to find links of a similarity of {percent} %")
    missed, agree = 0.0, 0  # the largest bound below which a binomial(WIDTH, s) lies with a probability of MISS at most
    while agree < WIDTH:
        missed += math.comb(WIDTH, agree) * s**agree * (1 - s) ** (WIDTH - agree)
        if missed > MISS:
            break
        agree += 1
    return Bounds(rows, bands, agree)


def super_minhash(elements: np.ndarray, offs: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """A row of ``slots`` values for each set: elements[offs[i]:offs[i + 1]].  Values are rank << 32 | fraction."""
    n = len(offs) - 1
    sig = np.full(n * slots, _NONE, dtype=ts.U)
    doc = np.repeat(np.arange(n), np.diff(offs))
    places = None  # each active element's permutation so far
    for rank in range(slots):
        if not len(elements):
            break
        draw = ts.mix(elements + ts.U((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        other = rank + (((draw & ts.U(0xFFFFFFFF)) * ts.U(slots - rank)) >> ts.U(32)).astype(np.int64)
        if rank == 0:
            slot = other
        else:
            if places is None:  # the swap of rank 0, now that this element goes on
                places = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                row = np.arange(len(elements))
                places[row, first], places[:, 0] = 0, first
            row = np.arange(len(elements))
            slot = places[row, other].astype(np.int64)
            places[row, other] = places[:, rank]
            places[:, rank] = slot
        np.minimum.at(sig, doc * slots + slot, (draw >> ts.U(32)) + ts.U(rank) * _ONE)
        if rank == 0:
            first = other
        open_ = sig.reshape(n, slots).max(axis=1) >= ts.U(rank + 1) * _ONE  # some slot could still be lowered
        go = open_[doc]
        elements, doc = elements[go], doc[go]
        if places is not None:
            places = places[go]
        else:
            first = first[go]
    return sig.reshape(n, slots)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag (a hash of the text, which tells apart texts of one doc_id) and text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, tag, n_shingles, set_a and set_b (128-bit hash of the shingle set) and sig (a byte for each slot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(2), ts.CHUNK_BYTES // 2):
                flat, at = ts.shingle_sets(buf, offs, shingle)
                sums = [np.concatenate([np.zeros(1, ts.U), np.cumsum(ts.mix(flat ^ ts.U(k)), dtype=ts.U)]) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                one, two = (np.diff(s[at]) for s in sums)
                low = np.hstack([ts.mix(super_minhash(ts.mix(flat + ts.U(k)), at)).astype(np.uint8) for k in range(DRAWS)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(at)), pa.array(ts.signed(one)), pa.array(ts.signed(two)),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                    ],
                    ["doc_id", "tag", "n_shingles", "set_a", "set_b", "sig"],
                )

    return keyed(docs).mapInArrow(run, "doc_id long, tag long, n_shingles long, set_a long, set_b long, sig binary")


def _sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), WIDTH)


def _band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """band << 40 | its bytes (five at most), for every row and band."""
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.int64)
    key = np.broadcast_to(np.arange(bands, dtype=np.int64) << 40, (len(sig), bands)).copy()
    for k in range(rows):
        key |= parts[:, :, k] << (8 * k)
    return key


def _bands(rows: int, bands: int):
    """key and node of every band of rows (node, sig)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = _band_keys(_sig_matrix(batch.column(1)), rows, bands)
                node = np.repeat(batch.column(0).to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(node)], ["key", "node"])

    return run


def _verify(shingle: int, percent: int):
    """Of rows (u, v, text_u, text_v), the pairs whose sets have 100 * common >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            right = batch.column(3)
            for a, b, buf, offs in ts.text_chunks(batch.column(2)):
                flat, at = ts.shingle_sets(buf, offs, shingle)
                for c, d, buf2, offs2 in ts.text_chunks(right.slice(a, b - a)):
                    flat2, at2 = ts.shingle_sets(buf2, offs2, shingle)
                    for k in range(c, d):
                        x, y = flat[at[k] : at[k + 1]], flat2[at2[k - c] : at2[k - c + 1]]
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        if common and 100 * common >= percent * (len(x) + len(y) - common):
                            kept.append(a + k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), batch.column(1).take(pa.array(kept, pa.int64()))], ["u", "v"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) that are links; texts: node and text of every class among them."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    rows = pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
    return rows.mapInArrow(_verify(shingle, percent), "u long, v long")


def _search(bound: Bounds):
    """Of rows sorted by key, one, two: pairs of different components that agree enough and share no earlier band."""

    def pairs(key: int, doc: np.ndarray, comp: np.ndarray, left: np.ndarray, sig: np.ndarray, own: bool) -> Iterator[pa.RecordBatch]:
        band = key >> 40
        i = np.arange(len(doc)) if own else np.flatnonzero(left)
        j = i if own else np.flatnonzero(~left)
        if not len(i) or not len(j):
            return
        keys = sig[:, : bound.bands * bound.rows].reshape(len(doc), bound.bands, bound.rows)
        for p in i.tolist():
            q = j[j > p] if own else j
            q = q[comp[q] != comp[p]]
            q = q[(sig[q] == sig[p]).sum(axis=1) >= bound.agree]
            if band and len(q):
                q = q[~(keys[q, :band] == keys[p, :band]).all(axis=2).any(axis=1)]
            if len(q):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(doc[q], doc[p])), pa.array(np.minimum(doc[q], doc[p]))], ["u", "v"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []
        for batch in batches:
            key, one, two, block, doc, comp = (batch.column(c).to_numpy() for c in range(6))
            sig = _sig_matrix(batch.column(6)) if batch.num_rows else None
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(key)]):
                if a == b:
                    continue
                new = (key[a], one[a], two[a])
                if new != name and held:
                    d, c, x, s = (np.concatenate(z) for z in zip(*held))
                    yield from pairs(int(name[0]), d, c, x == name[1], s, bool(name[1] == name[2]))
                    held = []
                name = new
                held.append((doc[a:b], comp[a:b], block[a:b], sig[a:b]))
        if held:
            d, c, x, s = (np.concatenate(z) for z in zip(*held))
            yield from pairs(int(name[0]), d, c, x == name[1], s, bool(name[1] == name[2]))

    return run


def _remaining(members: DataFrame, reps: DataFrame, found: DataFrame, bound: Bounds) -> DataFrame:
    """Candidate pairs (u, v) of buckets that hold several components."""
    now = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = now.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
    now = now.join(open_, "key")
    rows = _in_pairs(now.where(F.col("n") > BLOCK), BLOCK).unionByName(
        now.where(F.col("n") <= BLOCK).select("key", *(F.lit(0).cast("long").alias(c) for c in ("one", "two", "block")), "node", "component")
    )
    rows = rows.join(reps.select("node", "sig"), "node").select("key", "one", "two", "block", "node", "component", "sig")
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return rows.mapInArrow(_search(bound), "u long, v long").distinct()


def _in_pairs(now: DataFrame, block: int) -> DataFrame:
    """key, one, two, block, node, component: the members of large buckets, once for each pair of blocks that they are in.

    A component of more than ``block`` members has blocks of its own; the others share blocks.
    Pairs of blocks of one component are left out, so what is moved grows in proportion to a bucket
    that holds one large component, whatever else is in it.
    """
    sizes = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    own = F.when(F.col("size") > block, F.col("component"))
    groups = sizes.groupBy("key", own.alias("own")).agg(F.ceil(F.sum("size") / block).cast("long").alias("parts"))
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    parts = parts.withColumn("block", F.xxhash64("own", "part"))
    a, b = (parts.select("key", F.col("own").alias(f"own_{c}"), F.col("block").alias(c)) for c in ("one", "two"))
    pairs = a.join(b, "key").where((F.col("one") <= F.col("two")) & (F.col("own_one").isNull() | F.col("own_two").isNull() | (F.col("own_one") != F.col("own_two"))))
    sides = pairs.select("key", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    now = now.join(sizes, ["key", "component"]).withColumn("own", own)
    now = now.join(groups.withColumnRenamed("own", "group"), (now["key"] == groups["key"]) & now["own"].eqNullSafe(F.col("group"))).drop(groups["key"])
    now = now.withColumn("block", F.xxhash64("own", F.pmod(F.xxhash64("node"), F.col("parts"))))
    return now.join(sides, ["key", "block"]).select("key", "one", "two", "block", "node", "component")


def _classified(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, tag, n_shingles of every row, and doc_id and tag of the first document of its component."""
    bound = bounds(percent)
    sigs = staged(signatures(docs, shingle), "near-signatures")
    sets = sigs.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b")
    reps = sets.agg(F.min(F.struct("doc_id", "tag")).alias("first"), F.any_value("sig").alias("sig"))
    reps = reps.select("set_a", "set_b", "first.doc_id", "first.tag", "sig").repartitionByRange("doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    reps = staged(reps.withColumn("node", F.monotonically_increasing_id()), "near-classes")  # nodes in the order of doc_id: copies tend to follow their original
    bands = reps.select("node", "sig").mapInArrow(_bands(bound.rows, bound.bands), "key long, node long")
    buckets = bands.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(bands.join(buckets, "key"), "near-buckets")
    wanted = staged(reps.select("node", "doc_id", "tag").join(members.select("node").distinct(), "node"), "near-ids")
    texts = keyed(docs).join(bounded(wanted), ["doc_id", "tag"]).select("node", "text")
    if not sigs.groupBy("doc_id", "tag").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["node"])  # rows that repeat doc_id and text
    texts = staged(texts, "near-texts")

    first = members.groupBy("node").agg(F.min("center").alias("v")).where("v < node")
    links = staged(verified(first.select(F.col("node").alias("u"), "v"), texts, shingle, percent), "near-links")
    found = components(links)
    more = staged(verified(_remaining(members, reps, found, bound), texts, shingle, percent), "near-links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    linked = found.join(reps.select("node", "doc_id", "tag"), "node")
    least = linked.groupBy("component").agg(F.min(F.struct("doc_id", "tag")).alias("least"))
    linked = linked.join(least, "component").select("node", "least")
    of = reps.join(linked, "node", "left").select("set_a", "set_b", F.coalesce("least", F.struct("doc_id", "tag")).alias("least"))
    return sigs.drop("sig").join(of, ["set_a", "set_b"], "left").select("doc_id", "tag", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).alias("least"))


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row; see the module's text."""
    rows = _classified(docs, shingle, percent)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose component has an earlier document (by doc_id, then by a hash of the text); all columns as they are."""
    rows = _classified(docs, shingle, percent).where((F.col("least.doc_id") != F.col("doc_id")) | (F.col("least.tag") != F.col("tag")))
    gone = bounded(staged(rows.select("doc_id", "tag").distinct(), "near-gone"))
    same = (docs["doc_id"].cast("long") == gone["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["tag"])
    return docs.join(gone, same, "left_anti")
