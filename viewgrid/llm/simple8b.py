"""Simple-8b: unsigned ids packed into 64-bit little-endian words.

The top four bits of a word are its selector, the other 60 hold as many ids of
equal width as the selector says, the first in the lowest bits.  Selector 15
is the escape: the word after it is one raw 64-bit value.  The last word may
hold fewer ids than its selector allows; the number of ids is kept outside.
"""

from __future__ import annotations

import numpy as np

#: Ids in a word and bits of each, by selector.
COUNTS = np.array([120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = 15
MARK_EVERY = 256  # words between two marks

_U = np.uint64
_LIMITS = np.array([1 << b for b in BITS[:-1].tolist()], dtype=_U)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=_U), side="right").astype(np.uint8)


def width_class(ids: np.ndarray) -> np.ndarray:
    """Per id the first selector whose width holds it (15: none)."""
    if len(ids) and ids.max() < 1 << 16:
        return _SMALL[ids]
    return np.searchsorted(_LIMITS, ids, side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> np.ndarray:
    """Words that hold the ids, each with as many as fit."""
    n = len(ids)
    ids = np.concatenate([np.asarray(ids, dtype=_U), np.zeros(int(COUNTS[0]), dtype=_U)])
    widest = [width_class(ids)]  # widest[c - 1][i]: class of the widest of c ids from i
    best = np.where(widest[0][:n] == ESCAPE, ESCAPE, ESCAPE - 1).astype(np.uint8)
    run, size = widest[0], 1
    for selector in range(ESCAPE - 2, -1, -1):
        count = int(COUNTS[selector])
        while size < count:  # a longer window is the wider of two shorter ones
            step = min(size, count - size)
            run, size = np.maximum(run[: len(run) - step], run[step:]), size + step
        fits = run[:n] <= selector
        if not fits.any():
            continue
        best[fits] = selector
    step = np.maximum(COUNTS, 1)[best].tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at, dtype=np.int64)
    chosen = best[at]
    place = np.arange(len(at)) + np.cumsum(chosen == ESCAPE) - (chosen == ESCAPE)
    out = np.zeros(len(at) + int((chosen == ESCAPE).sum()), dtype=_U)
    for selector in np.unique(chosen).tolist():
        own = chosen == selector
        here, from_ = place[own], at[own]
        out[here] = _U(selector) << _U(60)
        if selector == ESCAPE:
            out[here + 1] = ids[from_]
        elif BITS[selector]:
            for k in range(int(COUNTS[selector])):
                out[here] |= ids[from_ + k] << _U(k * int(BITS[selector]))
    return out


def counts(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each word holds, and which words are raw values behind an escape."""
    selector = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    before = -2
    for p in np.flatnonzero(selector == ESCAPE).tolist():
        if p != before + 1:  # else it is itself the raw word of the escape before it
            raw[p + 1] = True
            before = p
    size = COUNTS[selector]
    size[raw] = 1
    return size, raw


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first n ids, one numpy pass for each selector."""
    size, raw = counts(words)
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=_U)
    selector = (words >> _U(60)).astype(np.int64)
    for s in range(ESCAPE):
        own = np.flatnonzero((selector == s) & ~raw)
        if not len(own) or not BITS[s]:
            continue
        mask = _U((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[first[own] + k] = (words[own] >> _U(k * int(BITS[s]))) & mask
    out[first[raw]] = words[raw]
    return out[:n]


def marks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """About every MARK_EVERY words, a word's index and the ids before it; never between an escape and its value."""
    size, raw = counts(words)
    first = np.cumsum(size) - size
    at = np.arange(0, len(words), MARK_EVERY)
    at = at - raw[at]
    return at, first[at]


def unpack_slice(words: np.ndarray, mark_word: np.ndarray, mark_id: np.ndarray, start: int, n: int) -> np.ndarray:
    """n ids from position start, decoded from the nearest mark on."""
    if n <= 0:
        return np.empty(0, dtype=_U)
    k = int(np.searchsorted(mark_id, start, side="right")) - 1
    end = int(np.searchsorted(mark_id, start + n, side="left"))
    last = int(mark_word[end]) if end < len(mark_word) else len(words)
    skip = start - int(mark_id[k])
    return unpack(words[int(mark_word[k]) : last], skip + n)[skip:]
