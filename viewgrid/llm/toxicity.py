"""Toxicity by FTRL-proximal logistic regression over hashed word features (operator 5).

Features of a document are the distinct hashes of its words, word pairs and
pairs around one word (skip-grams), and of the first four and six bytes of
each word, which let inflected forms share evidence.  Words are runs of
letters and digits, A-Z lower-cased; nothing but the text is read.

The learner sees a bounded sample of labelled documents (``FIT_ROWS``) in a fixed
order, in one task.  Every coordinate has its own rate; L1 leaves most weights
at zero, so the model is a short list of (feature, weight) that is broadcast.
Common features stay: where many documents are toxic, the markers are common too.

Defined results: a text without words (null, empty) scores the bias alone.
Rows without doc_id are scored and count as held out.  Repeated rows score
alike; the learner sees one row of a doc_id.  Without any usable label the score is 0.5.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.tables import id_and_text, labelled_sample, sampled_texts, staged

FIT_ROWS = 12_000  # labelled documents that the learner sees at most
BITS = 20  # features are hashed to 2**BITS coordinates
EPOCHS = 4
RATE, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.1
LEAST_DOCS = 5  # sampled documents in which a feature must occur
BIAS_RATE = 0.1
THRESHOLD = 0.7

NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document index and coordinate of every feature occurrence."""
    buf = ts.LOWER[buf]
    starts, ends, at = ts.words(buf, offs, NOT_WORD)
    sums = ts.prefix(buf)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    w = ts.span_hash(sums, starts, ends)
    docs, out = [doc], [w]
    for size in (4, 6):
        docs.append(doc)
        out.append(ts.mix(ts.span_hash(sums, starts, np.minimum(ends, starts + size)) + ts.U(size)))
    for gap in (1, 2):
        inside = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][inside])
        out.append(ts.mix(w[:-gap][inside] * ts.U(2 * gap + 1) + (w[gap:][inside] << ts.U(1))))
    return np.concatenate(docs), (np.concatenate(out) >> ts.U(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float64)
        dense[self.index] = self.weight
        doc, at = features(buf, offs)
        used = dense[at] != 0
        once = np.unique((doc[used] << BITS) | at[used])
        z = np.bincount(once >> BITS, weights=dense[once & ((1 << BITS) - 1)], minlength=len(offs) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def ftrl(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Weights after EPOCHS passes over the rows (arrays of distinct coordinates)."""
    seen = np.zeros(1 << BITS, np.int32)
    for x in rows:
        seen[x] += 1
    rows = [x[seen[x] >= LEAST_DOCS] for x in rows]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, bias_n = 0.0, 1.0
    for _ in range(EPOCHS):
        for x, y in zip(rows, labels):
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) <= L1, 0.0, -(zx - np.sign(zx) * L1) / ((BETA + root) / RATE + L2))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -40, 40))) - y
            z[x] = zx + g - (np.sqrt(nx + g * g) - root) / RATE * w
            n[x] = nx + g * g
            bias_n += g * g
            bias -= BIAS_RATE * g / np.sqrt(bias_n)
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / RATE + L2))
    index = np.flatnonzero(w)
    return Model(index, w[index], float(bias))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, buf, offs in ts.text_chunks(batch.column(2)):
            doc, at = features(buf, offs)
            once = np.unique((doc << BITS) | at)
            cut = np.searchsorted(once >> BITS, np.arange(b - a + 1))
            at = (once & ((1 << BITS) - 1)).astype("<i4")
            packed = [at[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(packed, pa.binary())], ["doc_id", "label", "features"]
            )


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        rows += [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column(2)]
        labels += batch.column(1).to_pylist()
    model = ftrl(rows, np.array(labels, dtype=np.float64))
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *model.index.tolist()], pa.int64()), pa.array([model.bias, *model.weight.tolist()], pa.float64())], ["feature", "weight"]
    )


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, bound: int = FIT_ROWS) -> Model:
    """Model of at most ``bound`` labelled documents whose labels row satisfies ``allowed``."""
    sample = staged(labelled_sample(labels, "toxic", allowed, bound), "toxic-sample")
    rows = sampled_texts(docs, sample).mapInArrow(_rows, "doc_id long, label int, features binary")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features"))
    found = rows.mapInArrow(_fit, "feature long, weight double").toPandas().sort_values("feature")  # at most 2**BITS rows
    if not len(found):
        return Model(np.empty(0, np.int64), np.empty(0), 0.0)
    return Model(found["feature"].to_numpy()[1:], found["weight"].to_numpy()[1:], float(found["weight"].iloc[0]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(shared.value.score(buf, offs))], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def not_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(names.index("text"))):
                yield batch.slice(a, b - a).filter(pa.array(shared.value.score(buf, offs) < threshold))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
