"""Removal of repeated passages by seed and extend (operator 4).

Every window of ``length`` words is represented by one seed: the rightmost
smallest hash of its ``SEED``-word runs (winnowing), so equal windows have equal
seeds at equal places.  The windows of one seed are consecutive; together they
span a segment, the seed extended both ways as far as it stands for windows.

1. Seeds of all documents are joined by hash.  Occurrences whose whole segments
   agree form a class: all its members but the first (by doc_id, then place) are
   repeats.  Seeds met with one segment only need nothing more.
2. Where one seed has several segments, the match ends inside them.  The first
   members of those classes are extended window by window (128-bit hashes), and
   windows that also start earlier are repeats.
3. The union of a document's repeats are its maximal repeated spans.

Hot seeds: a map task sends at most ``SPREAD`` first members of a seed and one
marker; more go straight to step 2.  There a map task sends a window at most
once.  So a group has a bounded number of rows for each map task, however many
documents share it, and no pairs are formed.  Groups are read as a sorted
stream with constant memory.

Defined results: windows are judged on the input.  Documents without a doc_id
have no order and keep all words; rows that repeat doc_id and text count as one
document.  Rows that share only the doc_id are documents of their own, told apart and
ordered by a tag made of two 64-bit hashes of the text (``tagged``).  Null and
empty texts have no words.  Other columns are kept or ignored, never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.tables import staged, with_ids

LENGTH = 20  # words of a window
SEED = 6  # words of a seed
SPREAD = 8  # first members of one seed that a map task sends to its group
FLUSH = 2_000_000  # rows a map task holds before it sends them

#: What a row of the grouping shuffles is.
MEMBER, REPEAT, UNSETTLED, MARKER = 0, 1, 2, 3
ROWS = "key long, sub long, doc_id long, tag long, start int, end int, kind byte"
SPANS = "doc_id long, tag long, start int, end int, unsettled boolean"


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text and rest (a struct of all other columns): the tag tells apart texts that share a doc_id.

    It is 0 where a doc_id has one text, and else the first hash of the text, counted up where a
    second hash says that two texts share it.
    """
    text = F.col("text").cast("string")
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("rest")
    one, two = F.xxhash64(text).alias("one"), F.xxhash64(F.lit(SEED), text).alias("two")
    hashes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), one, two).where("doc_id is not null")
    ends = hashes.groupBy("doc_id").agg(*(f(c).alias(f"{c}_{f.__name__}") for c in ("one", "two") for f in (F.min, F.max)))
    several = staged(ends.where("one_min <> one_max or two_min <> two_max").select("doc_id"), "op4-several")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), rest)
    if several.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("tag"), "text", "rest")
    names = with_ids(hashes, several, "left_semi").distinct()
    shared = Window.partitionBy("doc_id", "one").orderBy("two")  # of one text, but for a collision of 64 bits
    names = staged(names.withColumn("tag", F.col("one").bitwiseXOR(F.row_number().over(shared) - 1)), "op4-tags")
    rows = rows.withColumns({"one": F.xxhash64("text"), "two": F.xxhash64(F.lit(SEED), "text")})
    return rows.join(names, ["doc_id", "one", "two"], "left").select("doc_id", F.coalesce("tag", F.lit(0).cast("long")).alias("tag"), "text", "rest")


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the rightmost smallest of ``size`` values from each position on."""
    at = np.arange(len(values))
    have = 1
    while have < size:
        step = min(have, size - have)
        right = values[step:] <= values[:-step]
        values, at = np.where(right, values[step:], values[:-step]), np.where(right, at[step:], at[:-step])
        have += step
    return at


def segments(w: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Seed hash, segment hash, document index, first word in the document and end word of every segment."""
    own = np.repeat(np.arange(len(at) - 1), np.maximum(np.diff(at) - length + 1, 0))  # document of each window
    if not len(own):
        none = np.empty(0, np.int64)
        return none.view(ts.U), none.view(ts.U), none, none, none
    counts = np.maximum(np.diff(at) - length + 1, 0)
    begin = np.arange(len(own)) + np.repeat(at[:-1] - (np.cumsum(counts) - counts), counts)  # first word of each window
    g = ts.run_hashes(w, SEED)
    seed = smallest(g, length - SEED + 1)[begin]
    new = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
    last = np.append(new[1:], len(seed)) - 1
    start, end = begin[new], begin[last] + length
    doc = own[new]
    return g[seed[new]], range_hash(w, start, end), doc, start - at[doc], end - at[doc]


def range_hash(w: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = ts.BASE) -> np.ndarray:
    """Hash of the words from start to end."""
    power, inverse = ts.powers(len(w) + 1, base)
    sums = np.zeros(len(w) + 1, dtype=ts.U)
    np.cumsum(w * power[: len(w)], out=sums[1:])
    return ts.mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(ts.U))


def rows(key, sub, doc, tag, start, end, kind) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ts.signed(key), pa.int64()), pa.array(ts.signed(sub), pa.int64()), pa.array(doc, pa.int64()), pa.array(tag, pa.int64()),
            pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(np.full(n, kind, np.int8)),
        ],
        ["key", "sub", "doc_id", "tag", "start", "end", "kind"],
    )


def merged(doc, tag, start, end) -> tuple[np.ndarray, ...]:
    """Spans of each document with those that touch made one."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    if not len(doc):
        return doc, tag, start, end
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
    group = np.cumsum(fresh) - 1
    shift = group * (int(end.max()) + 1)  # later documents lie behind all earlier ones
    reach = np.maximum.accumulate(end + shift)
    new = fresh | np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], tag[at], start[at], (reach - shift)[np.append(at[1:], len(doc)) - 1]


class Groups:
    """What a map task holds back to find repeats of its own before it sends a group's rows."""

    def __init__(self, spread: int | None):
        self.spread, self.held, self.size = spread, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        key, sub, doc, tag, start, end = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.size = [], 0
        order = np.lexsort((start, tag, doc, sub, key))
        key, sub, doc, tag, start, end = key[order], sub[order], doc[order], tag[order], start[order], end[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], sub[1:] != sub[:-1]])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        same = (doc == doc[first]) & (tag == tag[first]) & (start == start[first])  # the first itself, or a repeated row
        d, t, s, e = merged(doc[~same], tag[~same], start[~same], end[~same])
        yield rows(ts.mix(d.astype(ts.U)), np.zeros(len(d), ts.U), d, t, s, e, REPEAT)
        key, sub, doc, tag, start, end, new_key = (c[new] for c in (key, sub, doc, tag, start, end, new_key))
        if self.spread:
            group = np.cumsum(new_key) - 1
            many = np.bincount(group)[group] > self.spread
            mark = many & new_key
            yield rows(key[mark], np.full(int(mark.sum()), 1 << 63, ts.U), doc[mark], tag[mark], start[mark], end[mark], MARKER)
            yield rows(ts.mix(key[many] ^ sub[many]), sub[many], doc[many], tag[many], start[many], end[many], UNSETTLED)
            key, sub, doc, tag, start, end = (c[~many] for c in (key, sub, doc, tag, start, end))
        yield rows(key, sub, doc, tag, start, end, MEMBER)


def _seeds(length: int, spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Groups(spread)
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy() for c in (0, 1))
            for a, b, buf, offs in ts.text_chunks(batch.column(2)):
                w, at = ts.word_hashes(buf, offs)
                key, sub, doc, start, end = segments(w, at, length)
                yield from groups.add(key, sub, ids[a:b][doc], tags[a:b][doc], start, end)
        yield from groups.flush()

    return run


def _windows(length: int):
    """Of the segments left unsettled, a row for every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Groups(None)
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy() for c in (0, 1))
            starts, ends = batch.column(3), batch.column(4)
            for a, b, buf, offs in ts.text_chunks(batch.column(2)):
                w, at = ts.word_hashes(buf, offs)
                one, two = starts.slice(a, b - a), ends.slice(a, b - a)
                n = one.value_lengths().to_numpy()
                doc = np.repeat(np.arange(b - a), n)
                from_ = one.flatten().to_numpy().astype(np.int64) + at[doc]
                size = two.flatten().to_numpy().astype(np.int64) + at[doc] - from_ - length + 1
                doc = np.repeat(doc, size)
                begin = np.repeat(from_ - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                place = np.unique(begin, return_index=True)[1]
                doc, begin = doc[place], begin[place]
                own = begin - at[doc]
                key, sub = range_hash(w, begin, begin + length), range_hash(w, begin, begin + length, ts.BASE_2)
                yield from groups.add(key, sub, ids[a:b][doc], tags[a:b][doc], own, own + length)
        yield from groups.flush()

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, sub, doc_id, tag, start: repeats, and the first members that need their windows compared."""
    last = None  # key, sub, first member of the class, whether the key is known to have several classes
    pending = None  # the first member of the only class of the key so far
    for batch in batches:
        if not batch.num_rows:
            continue
        key, sub, doc, tag, start, end, kind = (batch.column(c).to_numpy() for c in range(7))
        through = (kind == REPEAT) | (kind == UNSETTLED)
        out = [(doc[through], tag[through], start[through], end[through], kind[through] == UNSETTLED)]
        group = ~through
        key, sub, doc, tag, start, end, marker = (c[group] for c in (key, sub, doc, tag, start, end, kind == MARKER))
        n = len(key)
        if n:
            old_key = last is not None and key[0] == last[0]
            old_class = old_key and sub[0] == last[1]
            new_key = np.concatenate([[not old_key], key[1:] != key[:-1]])
            new = new_key | np.concatenate([[not old_class], sub[1:] != sub[:-1]])
            of = np.cumsum(new_key) - (0 if old_key else 1)  # group of each row; 0 may go on from before
            classes = np.bincount(of, weights=new & ~marker)
            classes += np.bincount(of, weights=2 * marker)
            if old_key:
                classes[0] += 2 if last[3] else 1
            several = classes >= 2
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            f = np.maximum(first, 0)
            fd, ft, fs = doc[f], tag[f], start[f]
            if old_class:
                went = first < 0
                fd, ft, fs = np.where(went, last[2][0], fd), np.where(went, last[2][1], ft), np.where(went, last[2][2], fs)
            repeat = ~marker & ~((doc == fd) & (tag == ft) & (start == fs))
            out.append((doc[repeat], tag[repeat], start[repeat], end[repeat], np.zeros(int(repeat.sum()), bool)))
            unsettled = new & ~marker & several[of]
            out.append((doc[unsettled], tag[unsettled], start[unsettled], end[unsettled], np.ones(int(unsettled.sum()), bool)))
            if old_key and several[0] and pending is not None:
                out.append(tuple(np.array([x]) for x in (*pending, True)))
            if len(classes) > 1 or not old_key or several[0]:
                pending = None
            if not several[-1] and new[of == len(classes) - 1].any():
                k = int(np.flatnonzero(new & (of == len(classes) - 1))[-1])
                pending = (doc[k], tag[k], start[k], end[k])
            last = (key[-1], sub[-1], (fd[-1], ft[-1], fs[-1]), bool(several[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))],
            ["doc_id", "tag", "start", "end", "unsettled"],
        )


def _grouped(sent: DataFrame) -> DataFrame:
    return sent.repartition("key").sortWithinPartitions("key", "sub", "doc_id", "tag", "start").mapInArrow(_settle, SPANS)


def _per_document(spans: DataFrame) -> DataFrame:
    """A row for each document.

    Of the spans that begin at one word the longest covers the others, so a document's list
    has at most one span for each of its words, however many map tasks sent spans of it.
    """
    longest = spans.groupBy("doc_id", "tag", "start").agg(F.max("end").alias("end"))
    return longest.groupBy("doc_id", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """doc_id, tag, starts, ends: word spans (they may overlap) covered by windows that also start earlier."""
    return _spans(tagged(docs), length, spread)


def _spans(texts: DataFrame, length: int, spread: int = SPREAD) -> DataFrame:
    """``repeated_spans`` of rows of ``tagged``."""
    known = texts.select("doc_id", "tag", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    one = staged(_grouped(known.mapInArrow(_seeds(length, spread), ROWS)), "op4-segments")
    open_ = _per_document(one.where("unsettled"))
    joined = known.join(open_.hint("shuffle_hash"), ["doc_id", "tag"]).select("doc_id", "tag", "text", "starts", "ends")
    two = _grouped(joined.mapInArrow(_windows(length), ROWS))
    repeats = one.unionByName(two).where("not unsettled")  # unsettled in the second step: different windows with one key
    return _per_document(repeats.select("doc_id", "tag", "start", "end"))


def removed_words(offs: np.ndarray, at: np.ndarray, starts: pa.ListArray, ends: pa.ListArray) -> np.ndarray:
    """Which words of a run of documents the spans cover."""
    doc = np.repeat(np.arange(len(offs) - 1), starts.value_lengths().fill_null(0).to_numpy())
    mark = np.zeros(int(at[-1]) + 1, np.int64)
    np.add.at(mark, at[doc] + starts.flatten().to_numpy(), 1)
    np.add.at(mark, at[doc] + ends.flatten().to_numpy(), -1)
    return np.cumsum(mark[:-1]) > 0


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, buf, offs in ts.text_chunks(batch.column(1)):
            first, last, at = ts.words(buf, offs)
            gone = removed_words(offs, at, batch.column(2).slice(a, b - a), batch.column(3).slice(a, b - a))
            raw, first, last = buf.tobytes(), first.tolist(), last.tolist()
            n_removed, sha = [], []
            for k in range(b - a):
                i, j = int(at[k]), int(at[k + 1])
                own = gone[i:j]
                n = int(own.sum())
                if n:
                    kept = b" ".join(raw[first[x] : last[x]] for x in (np.flatnonzero(~own) + i).tolist())
                else:
                    kept = b" ".join(raw[offs[k] : offs[k + 1]].split())
                n_removed.append(n)
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every document."""
    texts = tagged(docs).drop("rest")
    joined = texts.join(_spans(texts, length).hint("shuffle_hash"), ["doc_id", "tag"], "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, text, starts, ends = (batch.column(k) for k in range(4))
        new: list[str | None] = text.to_pylist()
        for a, b, buf, offs in ts.text_chunks(text):
            first, _, at = ts.words(buf, offs)
            gone = removed_words(offs, at, starts.slice(a, b - a), ends.slice(a, b - a))
            raw = buf.tobytes()
            for k in np.flatnonzero(starts.slice(a, b - a).value_lengths().fill_null(0).to_numpy()).tolist():
                i, j = int(at[k]), int(at[k + 1])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[i:j], [False]]).astype(np.int8)))  # run starts and ends
                place = [int(offs[k])]
                place += [int(first[i + x]) if i + x < j else int(offs[k + 1]) for x in edge.tolist()]
                place.append(int(offs[k + 1]))
                new[a + k] = b"".join(raw[p:q] for p, q in zip(place[::2], place[1::2])).decode("utf-8")
        yield pa.RecordBatch.from_arrays([row, pa.array(new, pa.string())], ["row", "text"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated spans cut out of text; all rows and columns stay, other words keep their white space.

    A column n_chars, if there is one, is made to fit the new text.
    """
    texts = tagged(docs)
    joined = texts.join(_spans(texts, length).hint("shuffle_hash"), ["doc_id", "tag"], "left")
    joined = joined.select(F.col("rest").alias("row"), "text", "starts", "ends")
    out = joined.mapInArrow(_cut, joined.select("row", "text").schema)
    fitted = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fitted["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(fitted.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
