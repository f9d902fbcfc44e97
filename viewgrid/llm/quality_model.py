"""Quality from random-indexing word vectors and a two-layer network (operator 6).

Tokens are runs of letters and digits, and runs of other signs, as they stand;
a token is hashed to one of ``BUCKETS`` rows.  Every row has a fixed sparse index
vector (one +1 and one -1 among ``DIMS`` places).  A word's vector is the sum of
the index vectors of its neighbours up to ``REACH`` tokens away in all
documents: tasks add up a table of bounded size and one partially aggregated
shuffle adds the tables.  Logarithms, centring and unit length follow.

A document is pooled to the mean and the spread of its vectors, the mean
product of neighbouring vectors, and the shares of distinct tokens and token
pairs.  The network (numpy, Adam) is fitted on a bounded sample of labelled
documents (``FIT_ROWS``); a temperature fitted on every fifth of them, which the
network doesn't see, calibrates its probabilities.

Defined results: a text without tokens (null, empty) is pooled to zeros and
scored.  Rows without doc_id are scored and count as held out.  Repeated rows
score alike; the network is fitted on one row of a doc_id.  Without any usable
label the score is 0.5.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.llm import textscan as ts
from viewgrid.llm.tables import id_and_text, labelled_sample, sampled_texts, staged

FIT_ROWS = 20_000
BUCKETS = 1 << 17
DIMS = 64
REACH = 2
HIDDEN = 32
EPOCHS = 30
THRESHOLD = 0.3
CHUNK = 1 << 20
BLOCK = 1 << 13  # tokens of a document whose vectors are looked up at once
ROWS = 1 << 13  # table rows in an Arrow batch
SEED = 7

_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[ts.IS_SPACE] = 0


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token and, per document, the index of its first token."""
    if not len(buf):
        return np.empty(0, ts.U), np.zeros(len(offs), np.int64)
    kind = _KIND[buf]
    new = np.concatenate([[True], kind[1:] != kind[:-1]])
    new[offs[:-1][offs[:-1] < len(buf)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(buf))
    solid = kind[starts] != 0
    starts, ends = starts[solid], ends[solid]
    return ts.span_hash(ts.prefix(buf), starts, ends), np.searchsorted(starts, offs)


def bucket(w: np.ndarray) -> np.ndarray:
    return (w & ts.U(BUCKETS - 1)).astype(np.int64)


def index_places() -> tuple[np.ndarray, np.ndarray]:
    """Where each row's index vector holds +1 and -1."""
    h = ts.mix(np.arange(1, BUCKETS + 1, dtype=ts.U))
    plus = (h % ts.U(DIMS)).astype(np.int64)
    return plus, (plus + 1 + ((h >> ts.U(32)) % ts.U(DIMS - 1)).astype(np.int64)) % DIMS


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plus, minus = index_places()
    total = np.zeros(BUCKETS * DIMS, np.int64)
    for batch in batches:
        for _, _, buf, offs in ts.text_chunks(batch.column(0), CHUNK):
            w, at = tokens(buf, offs)
            b = bucket(w)
            doc = np.repeat(np.arange(len(offs) - 1), np.diff(at))
            for gap in range(1, REACH + 1):
                inside = doc[gap:] == doc[:-gap]
                left, right = b[:-gap][inside], b[gap:][inside]
                for word, other in ((left, right), (right, left)):
                    np.add.at(total, word * DIMS + plus[other], 1)
                    np.add.at(total, word * DIMS + minus[other], -1)
    total = total.reshape(BUCKETS, DIMS)
    used = np.flatnonzero(total.any(axis=1))
    for a in range(0, len(used), ROWS):
        part = used[a : a + ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(total[part, k]) for k in range(DIMS))], ["bucket", *(f"d{k}" for k in range(DIMS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x DIMS vectors from all documents; the collected table has that bounded size (34 MB)."""
    names = [f"d{k}" for k in range(DIMS)]
    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_contexts, "bucket long, " + ", ".join(f"{c} long" for c in names))
    sums = parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names))
    logs = sums.select("bucket", *((F.signum(c) * F.log1p(F.abs(c))).cast("float").alias(c) for c in names)).toArrow()
    out = np.zeros((BUCKETS, DIMS))
    at = logs["bucket"].to_numpy()
    for k, c in enumerate(names):
        out[at, k] = logs[c].to_numpy()
    used = out.any(axis=1)
    if used.any():
        out[used] -= out[used].mean(axis=0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(vectors: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of 3 * DIMS + 3 figures for each document; a text has the same figures wherever it stands."""
    w, at = tokens(buf, offs)
    out = np.zeros((len(offs) - 1, 3 * DIMS + 3), np.float32)
    place = bucket(w)
    pair = ts.mix(w[:-1] * ts.U(3) + w[1:]) if len(w) > 1 else w[:0]
    for k in np.flatnonzero(np.diff(at)).tolist():
        a, b = int(at[k]), int(at[k + 1])
        size = b - a
        total, square, near = np.zeros((3, DIMS))
        for c in range(a, b, BLOCK):
            v = vectors[place[c : min(c + BLOCK + 1, b)]]  # one more than a block, the neighbour of its last token
            total += v[:BLOCK].sum(axis=0)
            square += np.einsum("ij,ij->j", v[:BLOCK], v[:BLOCK])
            near += np.einsum("ij,ij->j", v[:-1], v[1:])
        mean = total / size
        out[k, :DIMS] = mean
        out[k, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square / size - mean * mean, 0))
        out[k, 2 * DIMS : 3 * DIMS] = near / max(size - 1, 1)
        out[k, -3] = np.log1p(size)
        out[k, -2] = len(np.unique(w[a:b])) / size
        out[k, -1] = len(np.unique(pair[a : b - 1])) / (size - 1) if size > 1 else 1.0
    return out


@dataclass
class Network:
    """Two layers: inputs -> HIDDEN (tanh) -> one logit, divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIMS), np.float32))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x.astype(np.float64)) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Network of the rows x and labels y; every fifth row only calibrates."""
    inputs = x.shape[1]
    if not len(y):
        return Network(np.zeros(inputs), np.ones(inputs), np.zeros((inputs, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(SEED)
    fit_x, fit_y = x[~held].astype(np.float64), y[~held].astype(np.float64)
    net = Network(
        fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-3, rng.normal(0, inputs**-0.5, (inputs, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0
    )
    z = (fit_x - net.centre) / net.scale
    state = [np.zeros_like(p) for p in (net.w1, net.b1, net.w2, np.zeros(1)) for _ in range(2)]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit_y))
        for i in range(0, len(order), 128):
            part = order[i : i + 128]
            h = np.tanh(z[part] @ net.w1 + net.b1)
            d = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - fit_y[part]) / len(part)
            dh = np.outer(d, net.w2) * (1 - h * h)
            grads = [z[part].T @ dh + 1e-4 * net.w1, dh.sum(axis=0), h.T @ d + 1e-4 * net.w2, np.array([d.sum()])]
            step += 1
            moves = []
            for k, g in enumerate(grads):
                state[2 * k] = 0.9 * state[2 * k] + 0.1 * g
                state[2 * k + 1] = 0.999 * state[2 * k + 1] + 0.001 * g * g
                moves.append(0.003 * (state[2 * k] / (1 - 0.9**step)) / (np.sqrt(state[2 * k + 1] / (1 - 0.999**step)) + 1e-8))
            net.w1, net.b1, net.w2, net.b2 = net.w1 - moves[0], net.b1 - moves[1], net.w2 - moves[2], net.b2 - float(moves[3][0])
    if held.any():
        logit, truth = net.logit(x[held].astype(np.float64)), y[held]

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, logit / t) - truth * logit / t))

        net.temperature = min(np.geomspace(0.25, 8, 61).tolist(), key=loss)
    return net


def _pool(vectors, keep: int):
    """Pooled rows (packed) beside the first ``keep`` columns; the text is the column after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(keep), CHUNK):
                rows = [r.tobytes() for r in pooled(vectors.value, buf, offs)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in range(keep)), pa.array(rows, pa.binary())], [*batch.schema.names[:keep], "pooled"])

    return run


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, bound: int = FIT_ROWS) -> Network:
    """Word vectors of all documents, and a network of at most ``bound`` labelled ones whose labels row satisfies ``allowed``."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    sample = staged(labelled_sample(labels, "quality", allowed, bound), "quality-sample")
    rows = sampled_texts(docs, sample).mapInArrow(_pool(spark.sparkContext.broadcast(vectors), 2), "doc_id long, label int, pooled binary")
    rows = rows.toPandas().sort_values("doc_id")  # at most ``bound`` documents of 780 bytes
    x = np.frombuffer(b"".join(rows["pooled"]), np.float32).reshape(len(rows), 3 * DIMS + 3)
    order = np.argsort(ts.mix(rows["doc_id"].to_numpy().astype(ts.U)), kind="stable")
    net = train(x[order], rows["label"].to_numpy()[order])
    net.vectors = vectors
    return net


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in ts.text_chunks(batch.column(1), CHUNK):
                score = shared.value.probability(pooled(shared.value.vectors, buf, offs))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score)], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")
