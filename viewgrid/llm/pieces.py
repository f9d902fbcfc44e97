"""Byte-level BPE ids of whole texts, each distinct piece encoded once per worker.

A piece is a stretch of text between two safe cuts.  A cut is safe in front of
a space or newline that follows a non-space character, and in front of a comma
or the like that follows a letter: no pre-token of the byte-level pattern
holds such a pair of characters, so the place is always a pre-token boundary,
and what stands before it never depends on what follows.  Encoding the pieces one by one therefore gives exactly the ids of
encoding the text at once, and texts share most of their pieces.

Pieces are found and looked up with numpy by two independent 64-bit hashes; the
tokenizers library encodes those not seen before.  The memory of encoded pieces
is bounded by ``MOST_PIECES`` and emptied beyond it, which costs time only.
"""

from __future__ import annotations

from itertools import chain

import regex
import numpy as np
from tokenizers import Tokenizer

from viewgrid.llm import textscan as ts

MOST_PIECES = 600_000
#: Fixed value: the pre-token pattern of the byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPACE_OR_NEWLINE = np.zeros(256, dtype=bool)
_SPACE_OR_NEWLINE[[0x20, 0x0A]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,!?;:")] = True
_LETTERS = np.zeros(256, dtype=bool)  # bytes of A-Z, a-z and the letters U+00C0-U+00FF
_LETTERS[[*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)]] = True
_LETTERS[[0x97, 0xB7]] = False  # the signs among them
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Texts of these characters have the same pre-tokens under any Unicode version.
_COMMON = regex.compile(r"[ \n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
MOST_TOKENS = 50_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(other)) for b in range(256)]


def safe_cuts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sorted byte positions of all safe cuts, document starts included.

    The character before the cut must surely not be white space: printable
    ASCII, or a two-byte character led by 0xC3-0xDF.  Other characters may be
    Unicode white space and give no cut, which only makes a piece longer.
    """
    n = len(buf)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 1:
        before = (buf > 0x20) & (buf < 0x7F)
        before[1:] |= (buf[1:] >= 0x80) & (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xDF)
        cut[1:n] = (_SPACE_OR_NEWLINE[buf[1:]] & before[:-1]) | (_STOP[buf[1:]] & _LETTER[buf[:-1]])
    cut[offs] = True
    cut[n] = False
    return np.flatnonzero(cut)


def gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[first : first + size], end to end."""
    total = int(sizes.sum())
    if not total:
        return flat[:0]
    starts = np.cumsum(sizes) - sizes
    return flat[np.arange(total) + np.repeat(first - starts, sizes)]


class SpanMemory:
    """Ids of byte spans by two 64-bit hashes; ``encode(buf, starts, ends)`` gives ids and sizes of new ones.

    Emptied when it would pass ``most_spans`` or ``most_ids``, which costs time only.
    """

    def __init__(self, encode, most_spans: int, most_ids: int):
        self.encode, self.most_spans, self.most_ids = encode, most_spans, most_ids
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, ts.U)  # sorted
        self.checks = np.empty(0, ts.U)
        self.first = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def learn(self, buf: np.ndarray, keys: np.ndarray, checks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode the given spans (sorted by key) and keep their ids."""
        flat, sizes = self.encode(buf, starts, ends)
        first = len(self.flat) + np.cumsum(sizes) - sizes
        place = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, place, keys), np.insert(self.checks, place, checks)
        self.first, self.sizes = np.insert(self.first, place, first), np.insert(self.sizes, place, sizes)
        self.flat = np.concatenate([self.flat, flat])

    def spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the spans, end to end, and how many each has."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        h = ts.span_hash(ts.prefix(buf), starts, ends)
        g = ts.span_hash(ts.prefix(buf, ts.BASE_2), starts, ends, ts.BASE_2)
        keys, one, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most_spans or len(self.flat) > self.most_ids:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = one[~known]
            self.learn(buf, keys[~known], g[new], starts[new], ends[new])
            at = np.searchsorted(self.keys, keys)
        at = at[back]
        if not (self.checks[at] == g).all():  # two spans share a key: encode each for itself
            return self.encode(buf, starts, ends)
        return gather(self.flat, self.first[at], self.sizes[at]), self.sizes[at]


class PieceEncoder:
    """Encoder of one tokenizer file; one is kept for each worker process."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = byte_alphabet()
        self.translate = str.maketrans({chr(b): c for b, c in enumerate(self.alphabet)})
        self.pattern = regex.compile(PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        for s in self.special:
            raw = np.frombuffer(s.encode(), np.uint8)
            if len(safe_cuts(raw, np.array([0, len(raw)]))) > 1:
                raise ValueError(f"special token {s!r} holds a safe cut")
        self.plain: dict[str, list[int]] = {}
        self.memory = SpanMemory(self.encode_spans, MOST_PIECES, 4 * MOST_PIECES)

    def encode_piece(self, text: str) -> list[int]:
        if not _COMMON.fullmatch(text) or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids  # the library's own pre-tokens
        out: list[int] = []
        for token in self.pattern.findall(text):
            ids = self.plain.get(token)
            if ids is None:
                raw = token.encode("utf-8").decode("latin-1").translate(self.translate)
                ids = self.plain[token] = [t.id for t in self.tokenizer.model.tokenize(raw)]
            out += ids
        return out

    def encode_spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each span; a space and letters are one pre-token and go straight to the model."""
        sizes = ends - starts
        buf = gather(buf, starts, sizes)  # the spans alone, end to end
        ends = np.cumsum(sizes)
        starts = ends - sizes
        other = np.concatenate([[0], np.cumsum(~_LETTERS[buf])])
        lead = starts + (buf[starts] == 0x20)
        single = (other[ends] == other[lead]) & (ends > lead)
        raw = buf.tobytes()
        mapped = raw.decode("latin-1").translate(self.translate)
        tokenize, piece = self.tokenizer.model.tokenize, self.encode_piece
        out = [
            [t.id for t in tokenize(mapped[a:b])] if one else piece(raw[a:b].decode("utf-8"))
            for a, b, one in zip(starts.tolist(), ends.tolist(), single.tolist())
        ]
        if len(self.plain) > MOST_TOKENS:
            self.plain.clear()
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(sizes.sum())), sizes

    def documents(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, end to end, and how many each has."""
        starts = safe_cuts(buf, offs)
        ids, sizes = self.memory.spans(buf, starts, np.append(starts[1:], len(buf)))
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.searchsorted(starts, offs)])


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
