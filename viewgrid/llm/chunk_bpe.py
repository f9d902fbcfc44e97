"""BPE with content-defined chunk reuse (operator 9).

A rolling hash over the last ``WINDOW`` bytes cuts texts at places that depend on
the content alone, so that passages shared by documents fall into the same
chunks wherever they stand.

Chunks shared across documents are encoded once: a count of all chunk hashes
finds those that occur repeatedly, the ones that save the most bytes (about
``SHARED_BYTES`` of text and ``SHARED_CHUNKS`` chunks) are encoded by Spark tasks of their
own, and their ids go out as a broadcast dictionary.  Every other chunk is
encoded by the task that meets it, once as long as its memory holds it
(``MOST_CHUNKS``, ``MOST_IDS``; emptied beyond, which costs time only).

A chunk is encoded as it stands, cut inside words, so ids next to a cut may
differ from those of the whole text.  Joins are repaired: the stretch around a
cut is encoded anew by the tokenizers library, with one more piece on either
side, until the new ids of those outer pieces agree with the ids of both chunks;
where they don't, the stretch grows, up to the whole document.  Stretches begin and
end at safe cuts (``pieces``), where encodings never depend on what is beyond,
so the ids are exactly those of encoding the whole text.

Defined results: a null or empty text has no ids; rows are independent, so
repeated rows repeat their results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.pieces import PieceEncoder, SpanMemory, encoder, gather, safe_cuts
from viewgrid.llm.tables import staged

WINDOW = 16
CHUNK_BYTES = 1 << 19  # of text worked on at once; spelling its ids takes some 50 times as much memory
MEAN_CHUNK = 256  # bytes; a power of two
MOST_IDS = 2_000_000
MOST_CHUNKS = 100_000
SHARED_BYTES = 8 << 20
SHARED_CHUNKS = 32_768


def rolling_cuts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Document edges, and the character edges next behind a window of one document whose hash is 0 modulo MEAN_CHUNK."""
    if len(buf) <= WINDOW:
        return np.unique(offs)
    sums = ts.prefix(buf)
    n = len(buf) - WINDOW
    h = ts.mix((sums[WINDOW:-1] - sums[:n]) * ts.powers(len(sums))[1][:n])
    cuts = np.flatnonzero((h & ts.U(MEAN_CHUNK - 1)) == 0)  # starts of the windows
    cuts = cuts[cuts + WINDOW <= offs[np.searchsorted(offs, cuts, side="right")]] + WINDOW
    for _ in range(3):  # a character has at most three more bytes
        cuts = cuts + ((buf[np.minimum(cuts, len(buf) - 1)] & 0xC0 == 0x80) & (cuts < len(buf)))
    return np.unique(np.concatenate([offs, cuts]))


def chunk_keys(buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each chunk."""
    a, b = edges[:-1], edges[1:]
    return ts.span_hash(ts.prefix(buf), a, b), ts.span_hash(ts.prefix(buf, ts.BASE_2), a, b, ts.BASE_2)


class Dictionary(NamedTuple):
    """Ids of the chunks shared across documents, sorted by key."""

    keys: np.ndarray
    checks: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray


NOTHING = Dictionary(np.empty(0, ts.U), np.empty(0, ts.U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32))


class ChunkMemory(SpanMemory):
    """A memory that starts from a dictionary, also when it has been emptied."""

    start = NOTHING

    def begin(self, shared: Dictionary) -> None:
        self.start = shared
        self.most_spans, self.most_ids = MOST_CHUNKS + len(shared.keys), MOST_IDS + len(shared.flat)
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks, self.first, self.sizes, self.flat = self.start


class ChunkCoder:
    """Encodes and decodes runs of documents; one is kept for each worker process."""

    def __init__(self, path: str):
        self.pieces: PieceEncoder = encoder(path)
        self.memory = ChunkMemory(self.encode_spans, MOST_CHUNKS, MOST_IDS)
        self.stretches = SpanMemory(self.encode_whole, MOST_CHUNKS, MOST_IDS)
        tok = self.pieces.tokenizer
        byte = {c: b for b, c in enumerate(self.pieces.alphabet)}
        tokens = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size(with_added_tokens=True))]
        self.token_bytes, self.token_at = self.table([bytes(byte[c] for c in t) for t in tokens])
        self.digits, self.digits_at = self.table([b"%d," % i for i in range(len(tokens))])

    @staticmethod
    def table(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(items), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in items])])

    def encode_spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts
        return self.pieces.documents(gather(buf, starts, sizes), np.concatenate([[0], np.cumsum(sizes)]))

    def encode_whole(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each span from the library alone."""
        raw, tok = buf.tobytes(), self.pieces.tokenizer
        out = [tok.encode(raw[a:b].decode("utf-8"), add_special_tokens=False).ids for a, b in zip(starts.tolist(), ends.tolist())]
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(sizes.sum())), sizes

    def token_edges(self, ids: np.ndarray) -> np.ndarray:
        """Byte positions where tokens begin and, at last, end."""
        return np.concatenate([[0], np.cumsum(self.token_at[ids.astype(np.int64) + 1] - self.token_at[ids])])

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, end to end, and how many each has."""
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        edges = rolling_cuts(buf, offs)
        ids, sizes = self.memory.spans(buf, edges[:-1], edges[1:])
        ids = self.repaired(buf, offs, edges, ids)
        at = self.token_edges(ids)
        return ids, np.diff(np.searchsorted(at, offs))

    def repaired(self, buf: np.ndarray, offs: np.ndarray, edges: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """``ids`` of the chunks between ``edges`` with the ids around each join encoded anew, until both sides agree."""
        safe = np.append(safe_cuts(buf, offs), len(buf))
        last = len(safe) - 1
        border = np.isin(safe, offs)  # stretches stay inside a document
        joins = np.setdiff1d(edges, offs)
        left = np.searchsorted(safe, joins, side="right") - 1
        right = np.searchsorted(safe, joins)
        at = self.token_edges(ids)
        while len(left):
            outer_left = np.where(border[left], left, np.maximum(left - 1, 0))
            outer_right = np.where(border[right], right, np.minimum(right + 1, last))
            apart = np.concatenate([[True], outer_left[1:] >= outer_right[:-1]])
            first = np.flatnonzero(apart)  # joins whose stretches overlap have one stretch in common
            final = np.append(first[1:], len(left)) - 1
            marks = safe[np.stack([outer_left[first], left[first], right[final], outer_right[final]])]
            place = np.searchsorted(at, marks)
            agree = (at[place] == marks).all(axis=0)
            fresh, sizes = self.stretches.spans(buf, marks[0], marks[3])
            ends = np.cumsum(sizes)
            before, behind = place[1] - place[0], place[3] - place[2]
            agree &= before + behind <= sizes
            for start, old, n in ((ends - sizes, place[0], before), (ends - behind, place[2], behind)):
                n = np.where(agree, n, 0)
                unlike = np.concatenate([[0], np.cumsum(gather(fresh, start, n) != gather(ids, old, n))])
                agree &= unlike[np.cumsum(n)] == unlike[np.cumsum(n) - n]
            if agree.all():
                pool = np.concatenate([ids, fresh])
                kept_from = np.concatenate([[0], place[2]])
                kept = np.append(place[1], len(ids)) - kept_from
                inner = np.append(sizes - before - behind, 0)
                inner_from = np.append(len(ids) + ends - sizes + before, 0)
                return gather(pool, np.stack([kept_from, inner_from], axis=1).ravel(), np.stack([kept, inner], axis=1).ravel())
            wider = np.repeat(~agree, final - first + 1)
            left, right = np.where(wider, outer_left, left), np.where(wider, outer_right, right)
        return ids

    def spell(self, ids: np.ndarray, table: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table entries of the ids, end to end, and where each document's begin."""
        lens = at[ids + 1] - at[ids]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return gather(table, at[ids], lens), ends[np.concatenate([[0], np.cumsum(sizes)])]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each document; bytes that aren't UTF-8 become replacement characters."""
        raw, at = self.spell(ids, self.token_bytes, self.token_at, sizes)
        raw, at = raw.tobytes(), at.tolist()
        return [raw[a:b].decode("utf-8", errors="replace") for a, b in zip(at, at[1:])]


_coders: dict[str, ChunkCoder] = {}


def coder(path: str) -> ChunkCoder:
    if path not in _coders:
        _coders[path] = ChunkCoder(path)
    return _coders[path]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, chunk edges) of the texts in the first column."""
    for batch in batches:
        for _, _, buf, offs in ts.text_chunks(batch.column(0), CHUNK_BYTES):
            if len(buf):
                yield buf, rolling_cuts(buf, offs)


def repeated(docs: DataFrame) -> DataFrame:
    """key, check, size and n of the chunks that occur ``n`` > 1 times in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buf, edges in _texts(batches):
            keys, checks = chunk_keys(buf, edges)
            columns = [pa.array(ts.signed(keys)), pa.array(ts.signed(checks)), pa.array(np.diff(edges))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "check", "size"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, check long, size long")
    counts = rows.groupBy("key", "check").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def most_saving(chunks: DataFrame) -> DataFrame:
    """key and check of the chunks that save most: about SHARED_BYTES of text and SHARED_CHUNKS chunks.

    Powers of two of the bytes saved are counted, so 64 rows at most reach the driver; of the
    power that fits in part, chunks are taken by their hash.
    """
    level = F.floor(F.log2(F.col("size") * (F.col("n") - 1))).cast("int")
    counts = chunks.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("chunks"), F.sum("size").alias("bytes")).collect()
    room, room_bytes, taken = SHARED_CHUNKS, SHARED_BYTES, F.lit(False)
    for r in sorted(counts, key=lambda r: -r.level):
        share = min(1.0, room / r.chunks, room_bytes / r.bytes)
        taken = taken | ((level == r.level) & (F.pmod("check", F.lit(1024)) < int(1024 * share)))
        room, room_bytes = room - r.chunks, room_bytes - r.bytes
        if share < 1:
            break
    return chunks.where(taken).select("key", "check")


def shared_chunks(docs: DataFrame, tokenizer: str) -> Dictionary:
    """The dictionary of ``docs``; what reaches the driver is bounded by SHARED_BYTES and SHARED_CHUNKS."""
    wanted = most_saving(staged(repeated(docs), "op9-chunks")).toArrow()
    keys, checks = (wanted.column(k).to_numpy().view(ts.U) for k in ("key", "check"))
    order = np.argsort(keys)
    keys, checks = keys[order], checks[order]
    alone = np.ones(len(keys), bool)
    alone[1:] = keys[1:] != keys[:-1]
    sent = docs.sparkSession.sparkContext.broadcast((keys[alone], checks[alone]))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, checks = sent.value
        open_ = np.ones(len(keys) + 1, bool)  # not sent by this task yet; the last is of other chunks
        open_[-1] = False
        for buf, edges in _texts(batches):
            key, check = chunk_keys(buf, edges)
            at = np.searchsorted(keys, key)
            near = np.minimum(at, len(keys) - 1)
            at = np.where((keys[near] == key) & (checks[near] == check), at, len(keys)) if len(keys) else np.zeros_like(at)
            at, one = np.unique(at, return_index=True)
            one = one[open_[at]]
            open_[at] = False
            raw = [buf[a:b].tobytes() for a, b in zip(edges[one].tolist(), edges[one + 1].tolist())]
            columns = [pa.array(ts.signed(key[one])), pa.array(ts.signed(check[one])), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "check", "raw"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        for batch in batches:
            raw = batch.column(2).to_pylist()
            ends = np.cumsum([0, *map(len, raw)])
            ids, sizes = own.encode_spans(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:])
            packed, cut = ids.astype("<u4"), np.concatenate([[0], np.cumsum(sizes)]).tolist()
            ids = pa.array([packed[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], ["key", "check", "ids"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(texts, "key long, check long, raw binary")
    rows = rows.groupBy("key", "check").agg(F.min("raw").alias("raw"))
    rows = rows.repartition(16, "key").mapInArrow(encoded, "key long, check long, ids binary").toArrow()
    keys, checks = (rows.column(k).to_numpy().view(ts.U) for k in ("key", "check"))
    order = np.argsort(keys)
    ids = rows.column("ids").to_pylist()
    ids = [ids[k] for k in order.tolist()]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    return Dictionary(keys[order], checks[order], np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(ids), "<u4"))


def _each(docs: DataFrame, tokenizer: str, fields: str, row) -> DataFrame:
    """A row (doc_id, *row) for each document, from its ids, sizes and the worker's coder."""
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        own.memory.begin(shared.value)
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(1), CHUNK_BYTES):
                ids, sizes = own.encode(buf, offs)
                columns = row(own, ids.astype(np.int64), sizes)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns.values()], ["doc_id", *columns])
        own.memory.begin(NOTHING)  # idle workers hold memory that other tasks need
        own.stretches.clear()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {fields}")


def _sha256(parts: list[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string())


def digest(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of every document.

    ``with_ids`` adds the ids themselves, as little-endian unsigned 32-bit integers in a binary column.
    """

    def row(own: ChunkCoder, ids: np.ndarray, sizes: np.ndarray) -> dict[str, pa.Array]:
        raw, at = own.spell(ids, own.digits, own.digits_at, sizes)
        raw, at = raw.tobytes(), at.tolist()
        texts = own.decode(ids, sizes)
        out = {
            "n_tokens": pa.array(sizes, pa.int64()),
            "ids_sha256": _sha256([raw[a : max(a, b - 1)] for a, b in zip(at, at[1:])]),
            "decoded_sha256": _sha256([t.encode("utf-8") for t in texts]),
        }
        if with_ids:
            packed, cut = ids.astype("<u4"), np.concatenate([[0], np.cumsum(sizes)]).tolist()
            out["ids"] = pa.array([packed[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())
        return out

    return _each(docs, tokenizer, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids, row)


def decoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the text decoded from the ids of every document."""

    def row(own: ChunkCoder, ids: np.ndarray, sizes: np.ndarray) -> dict[str, pa.Array]:
        return {"text": pa.array(own.decode(ids, sizes), pa.string())}

    return _each(docs, tokenizer, "text string", row)
