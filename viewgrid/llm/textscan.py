"""Vectorised text helpers that run inside Arrow tasks.

A record batch's text column is one UTF-8 buffer with offsets; everything here
works on that buffer with numpy, a bounded number of bytes at a time, so no
Python object is made per word.  Hashes are 64-bit polynomials modulo 2**64
over bytes (or over word hashes), taken from prefix sums and finished by a
bit mixer, so equal byte sequences hash alike in every task and every run.

Words are maximal runs of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20  # bytes of text worked on at once (one longer document still goes whole)

BASE = 0x9E3779B97F4A7C15 | 1
BASE_2 = 0xD1342543DE82EF95 | 1
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per process, grown as needed)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)

        def run(b: int) -> np.ndarray:
            out = np.full(size, b & _MASK, dtype=U)
            out[0] = 1
            return np.multiply.accumulate(out)

        have = _powers[base] = (run(base), run(pow(base, -1, 1 << 64)))
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def words(buf: np.ndarray, offs: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per document the index of its first word (one more at the end)."""
    n = len(buf)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~space[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = solid[cut]  # a document's first byte never continues the one before
    last[cut - 1] = solid[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def prefix(buf: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums of (byte + 1) * base**i, for span_hash."""
    out = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum((buf.astype(U) + U(1)) * powers(len(buf), base)[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each byte span, whatever its place in the buffer."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), base)[1][starts])


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and, per document, the index of its first word."""
    if lower:
        buf = LOWER[buf]
    starts, ends, at = words(buf, offs)
    return span_hash(prefix(buf), starts, ends), at


def run_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position (len(w) - k + 1 values; runs across documents are the caller's to skip)."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U)
    sums = np.zeros(len(w) + 1, dtype=U)
    pw, inv = powers(len(w) + 1, BASE_2)
    np.cumsum(w * pw[: len(w)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * inv[:n] + U(k))


def doc_runs(at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document, first and end index into run_hashes of its own k-word runs (empty for fewer words)."""
    first = at[:-1]
    return first, np.maximum(at[1:] - k + 1, first)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of each document, end to end, with offsets.

    A document with fewer than k words has its whole word sequence as one
    shingle; one without words has none.
    """
    w, at = word_hashes(buf, offs, lower)
    g = run_hashes(w, k)
    first, end = doc_runs(at, k)
    sets = []
    for a, b, i, j in zip(first.tolist(), end.tolist(), at[:-1].tolist(), at[1:].tolist()):
        if b > a:
            sets.append(np.unique(g[a:b]))
        elif j > i:
            sets.append(run_hashes(w[i:j], j - i))
        else:
            sets.append(np.empty(0, dtype=U))
    sizes = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=sizes[1:])
    return (np.concatenate(sets) if sets else np.empty(0, dtype=U)), sizes


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return np.ascontiguousarray(h).view(np.int64)
