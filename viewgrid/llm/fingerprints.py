"""Document fingerprints by winnowing (operator 13).

Every run of ``GRAM`` code points is hashed (rolling: a polynomial from prefix sums).  Of
each window of consecutive grams the one with the smallest hash is chosen, the
rightmost if several are smallest, and kept with its position.  So two texts that
share a run of ``GRAM`` + w - 1 code points, w the larger of their windows, share
a chosen gram inside it.  Texts with g grams have windows of the largest power of two up
to g / ``ENTRIES``, within ``WINDOWS``; a shorter window chooses all that a longer one
does, so fingerprints of short and long texts can be compared.

A fingerprint is a string: for each chosen gram, in order, the 16 base64 characters of
its position (code points, unsigned 32 bits) and its hash (unsigned 64 bits),
both big-endian; ``entries`` reads it back.  The likeness of two fingerprints is
the number of distinct hashes they share over the number of distinct hashes they have.

``beside_next`` sets every document against the next one by falling doc_id.  The order is
cut at the keys of a range-partitioned sort of ids alone.  A document goes to its
part, and the first of a part also to the end of the part before, so that every text is
shuffled once and each task reads its parts as a sorted stream.

Defined results: a null text counts as empty.  A text of less than ``GRAM`` code points
is one gram; an empty one has the fingerprint ''.  Two empty fingerprints have the likeness 1, an
empty and another one 0.  Rows without doc_id come last in the order; rows that
share a doc_id are ordered by a hash of their text.  Of rows that repeat id and text, the
next of all but one is the same text; a map task sends one of them to the part and
deals the others over all parts, so repeated rows don't meet in one task.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.substring import smallest
from viewgrid.llm.tables import id_and_text

GRAM = 12  # code points
WINDOWS = (4, 64)  # grams of the smallest and the largest window; powers of two
ENTRIES = 16
CHUNK_CHARS = 1 << 18  # code points worked on at once (one longer document still goes whole)
PARTS = 4  # parts of the order for each shuffle partition
ENTRY = np.dtype([("position", ">u4"), ("hash", ">u8")])
WIDTH = 16  # characters of an entry

#: What a row of the shuffle is: in the part's order, the first of the next part, or one that is followed by its like.
MEMBER, TAIL, REPEAT = 0, 1, 2
DEALT = "part long, kind byte, absent int, place long, tie long, doc_id long, text string"
BESIDE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def window(grams: int) -> int:
    """Grams in a window of a text with so many."""
    return min(max(1 << max(grams // ENTRIES, 1).bit_length() - 1, WINDOWS[0]), WINDOWS[1])


def chosen(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Entries (position, hash) of all texts, end to end, and where those of each begin."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(ts.U) + ts.U(1)
    hashes = ts.run_hashes(points, GRAM)
    grams = np.maximum(sizes - GRAM + 1, 0)
    of, position, value = [], [], []
    for k in np.flatnonzero((sizes > 0) & (grams < WINDOWS[0])).tolist():  # one window, or less
        a = int(begin[k])
        own = hashes[a : a + grams[k]] if grams[k] else ts.run_hashes(points[a : a + sizes[k]], int(sizes[k]))
        at = len(own) - 1 - int(np.argmin(own[::-1]))
        of.append([k])
        position.append([at])
        value.append(own[at : at + 1])
    classes = np.array([window(g) for g in grams.tolist()], np.int64)
    classes[grams < WINDOWS[0]] = 0
    for w in np.unique(classes[classes > 0]).tolist():
        docs = np.flatnonzero(classes == w)
        n = grams[docs]
        base = np.cumsum(n) - n
        row = np.repeat(np.arange(len(docs)), n)
        own = hashes[np.arange(int(n.sum())) - base[row] + begin[docs][row]]
        least = smallest(own, w)
        first = np.arange(len(own)) - base[row] <= n[row] - w  # places where a whole window begins
        pick = least[np.flatnonzero(first)]
        pick = pick[np.concatenate([[True], pick[1:] != pick[:-1]])]  # they never go back within a text
        of.append(docs[row[pick]])
        position.append(pick - base[row[pick]])
        value.append(own[pick])
    if not of:
        return np.empty(0, ENTRY), np.zeros(len(texts) + 1, np.int64)
    doc = np.concatenate(of)
    order = np.argsort(doc, kind="stable")
    out = np.empty(len(doc), ENTRY)
    out["position"], out["hash"] = np.concatenate(position)[order], np.concatenate(value)[order]
    return out, np.searchsorted(doc[order], np.arange(len(texts) + 1))


def entries(fingerprint: str) -> np.ndarray:
    """Positions and hashes of a fingerprint."""
    return np.frombuffer(base64.b64decode(fingerprint), ENTRY)


class Fingerprints:
    """Of a list of texts: the strings, and the likeness of two of them."""

    def __init__(self, texts: list[str]):
        chosen_, at = chosen(texts)
        self.line = base64.b64encode(chosen_.tobytes()).decode("ascii")
        self.at = at.tolist()
        flat = chosen_["hash"].tolist()
        self.sets = [frozenset(flat[a:b]) for a, b in zip(self.at, self.at[1:])]

    def text(self, k: int) -> str:
        return self.line[WIDTH * self.at[k] : WIDTH * self.at[k + 1]]

    def likeness(self, i: int, j: int) -> float:
        a, b = self.sets[i], self.sets[j]
        common = len(a & b)
        return common / (len(a) + len(b) - common) if a or b else 1.0


def _chunks(rows: Iterator[tuple], size) -> Iterator[list[tuple]]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= CHUNK_CHARS:
            yield held
            held, total = [], 0
    if held:
        yield held


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((d, t or "") for batch in batches for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for held in _chunks(rows, lambda r: len(r[1])):
            own = Fingerprints([t for _, t in held])
            strings = [own.text(k) for k in range(len(held))]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array(strings, pa.string())], ["doc_id", "fingerprint"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text, and the order by falling doc_id: absent, place, tie."""
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    place: Column = F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long"))
    return rows.select(F.col("doc_id").isNull().cast("int").alias("absent"), place.alias("place"), F.xxhash64("text").alias("tie"), "doc_id", "text")


def _starts(rows: DataFrame, parts: int) -> list[tuple[int, int, int]]:
    """The first key of every part, at most ``parts`` of them; only ids and hashes are shuffled."""
    key = ("absent", "place", "tie")
    dealt = rows.select(*key).distinct().repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id())
    return sorted(tuple(r.first) for r in dealt.groupBy("part").agg(F.min(F.struct(*key)).alias("first")).collect())


def _dealt(starts: list[tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # of this task's rows
        repeats = 0
        for batch in batches:
            row, part, kind = [], [], []
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if key in seen:
                    repeats += 1
                    row.append(k)
                    part.append(int(ts.mix(np.array([repeats], ts.U))[0]) % len(starts))
                    kind.append(REPEAT)
                    continue
                seen.add(key)
                at = bisect_right(starts, key) - 1
                row.append(k)
                part.append(at)
                kind.append(MEMBER)
                if starts[at] == key:
                    row.append(k)
                    part.append((at - 1) % len(starts))
                    kind.append(TAIL)
            rest = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.int8()), *rest.columns], ["part", "kind", *rest.schema.names])

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text, text of the next) of rows sorted by part, kind and key."""
    now, waits = None, None
    for batch in batches:
        for part, kind, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "doc_id", "text"))):
            if kind == REPEAT:
                yield doc_id, text, text
                continue
            if part != now:
                now, waits = part, None
            if waits is not None:
                yield (*waits, text)
            waits = (doc_id, text) if kind == MEMBER else None


def edited(text: str, other: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``other``."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _chunks(_pairs(batches), lambda r: 2 * len(r[1])):
        n = len(held)
        texts = [t for _, t, _ in held]
        changed = [edited(t, x) for _, t, x in held]
        following = []
        for k, (_, _, x) in enumerate(held):
            if k + 1 < n and held[k + 1][1] is x:
                following.append(k + 1)
            else:
                following.append(len(texts))
                texts.append(x)
        shift = len(texts)
        own = Fingerprints(texts + changed)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in held], pa.int64()), pa.array([len(t) for _, t, _ in held], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([own.text(k) for k in range(n)], pa.string()), pa.array([own.text(shift + k) for k in range(n)], pa.string()),
                pa.array([own.likeness(k, shift + k) for k in range(n)], pa.float64()), pa.array([own.likeness(k, j) for k, j in enumerate(following)], pa.float64()),
            ],
            BESIDE.replace(" long", "").replace(" string", "").replace(" double", "").split(", "),
        )


def beside_next(docs: DataFrame) -> DataFrame:
    """The fingerprint of every row, of its text edited with the next document's, and their likeness.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    (to the next document itself); the next of the last document is the first one.
    """
    rows = _keyed(docs)
    starts = _starts(rows, PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not starts:
        return docs.sparkSession.createDataFrame([], BESIDE)
    dealt = rows.mapInArrow(_dealt(starts), DEALT).repartition("part")
    return dealt.sortWithinPartitions("part", "kind", "absent", "place", "tie").mapInArrow(_beside, BESIDE)
