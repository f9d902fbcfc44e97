"""Toxicity and quality classifiers: held-out accuracy on the given labels, folds, and odd inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from viewgrid.llm import quality_model, toxicity
from viewgrid.llm import textscan as ts
from viewgrid.llm.queries import QUERIES
from viewgrid.llm.tables import fold, labelled_sample, sampled_texts

SF = "/root/testdata/sf0.1"  # the smallest with enough labels to learn from


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(1, len(score) + 1)
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("name, column, folds, held, least, threshold", [("op5_toxicity", "toxic", 3, 1, 0.97, 0.7), ("op6_quality_model", "quality", 5, 0, 0.99, 0.3)])
def test_held_out(spark, name, column, folds, held, least, threshold):
    out = QUERIES[name](spark, SF).toPandas()
    assert list(out.columns) == ["doc_id", "held_out", "score", "predicted"] and len(out) == 10_000
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % folds == held)).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= threshold)).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")[column]
    test = out[out.held_out & out.doc_id.isin(labels.index)]
    y = labels.loc[test.doc_id].to_numpy()
    assert auc(test.score.to_numpy(), y) > least
    right = (test.predicted.to_numpy() == y).mean()
    assert right > 0.96


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    held = fold("doc_id", 3) == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit(docs, x, ~held) for x in (labels, other))
    assert (one.index == two.index).all() and (one.weight == two.weight).all() and one.bias == two.bias


def test_labelled_sample_is_bounded_and_clean(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)] + [(3, 0), (4, 1), (None, 1), (500, None), (501, 7)], "doc_id long, toxic int")
    rows = labelled_sample(labels, "toxic", F.lit(True), 1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(100))
    assert {r.doc_id: r.label for r in rows}[4] == 1 and {r.doc_id: r.label for r in rows}[3] == 1
    assert labelled_sample(labels, "toxic", F.lit(True), 30).count() == 30


def test_a_repeated_doc_id_counts_once_in_the_fit(spark, monkeypatch):
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(words[k : k + 30]) + " idiot" * (k % 3 == 0)) for k in range(200)]
    more = [(7, f"again {k} and again") for k in range(500)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0), int(k % 3 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    sizes = []
    train = quality_model.train
    monkeypatch.setattr(quality_model, "train", lambda x, y: sizes.append(len(y)) or train(x, y))
    quality_model.fit(odd(spark, rows + more), labels, F.lit(True), bound=150)
    assert sizes[0] <= 150
    sample = labelled_sample(labels, "toxic", F.lit(True), 1000)
    texts = sampled_texts(odd(spark, rows + more), sample).toPandas()
    assert sorted(texts.doc_id) == list(range(200)) and texts.label.sum() == 67
    assert sampled_texts(odd(spark, more + rows), sample).toPandas().set_index("doc_id").text[7] == texts.set_index("doc_id").text[7]
    same = [(7, rows[7][1])] * 500
    one, two = (toxicity.fit(odd(spark, x), labels, F.lit(True)) for x in (rows, rows + same))
    assert (one.index == two.index).all() and (one.weight == two.weight).all() and one.bias == two.bias


def odd(spark, rows):
    return spark.createDataFrame([(d, t, 0.5, 1) for d, t in rows], "doc_id long, text string, score double, label int")


def test_odd_rows_and_no_labels(spark):
    docs = odd(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "idiot " * 3), (4, "long " * 100_000)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model, net = toxicity.fit(docs, labels, F.lit(True)), quality_model.fit(docs, labels, F.lit(True))
    for scores in (toxicity.scored(docs, model), quality_model.scored(docs, net)):
        rows = scores.collect()
        assert len(rows) == 6 and {r.score for r in rows} == {0.5}
    kept = toxicity.not_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 6
    none = odd(spark, [])
    assert toxicity.scored(none, model).count() == quality_model.scored(none, net).count() == toxicity.not_toxic(none, model).count() == 0
    assert toxicity.fit(none, labels, F.lit(True)).bias == 0 and quality_model.word_vectors(none).any() == False  # noqa: E712


def test_sample_is_the_first_by_hash(spark):
    """The cut by hash ranges takes the rows that a sort of all would take."""
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic")).repartition(7)
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    for bound in (1, 40, 2999, 3000, 9000):
        assert sorted(r.doc_id for r in labelled_sample(labels, "toxic", F.lit(True), bound).collect()) == sorted(order[:bound])


def test_ftrl_against_one_coordinate_at_a_time():
    r = np.random.default_rng(3)
    rows = [np.unique(r.integers(0, 60, 12)) for _ in range(150)]
    labels = np.array([float(3 in x or 7 in x) for x in rows])
    weight, bias = brute.ftrl(rows, labels, toxicity)
    model = toxicity.ftrl(rows, labels)
    assert model.index.tolist() == sorted(weight) and 0 < len(weight) < 60
    assert np.allclose(model.weight, [weight[i] for i in sorted(weight)]) and np.isclose(model.bias, bias)


def test_network_and_temperature():
    """The network learns a plain rule; its temperature has the least loss of all on the rows kept for it."""
    r = np.random.default_rng(5)
    x = r.normal(size=(1000, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    net = quality_model.train(x, y)
    held = np.arange(1000) % 5 == 4

    def loss(part, t=1.0):
        z = net.logit(x[part]) / t
        return float(np.mean(np.logaddexp(0, z) - y[part] * z))

    assert loss(~held) < 0.2 and net.temperature in np.geomspace(0.25, 8, 61)
    assert loss(held, net.temperature) == min(loss(held, t) for t in np.geomspace(0.25, 8, 61))


def test_word_vectors_against_a_plain_loop(spark):
    texts = ["the cat sat, on the mat", "the dog sat", None, "", "one", "cat cat cat dog"]
    plus, minus = quality_model.index_places()
    out = np.zeros((quality_model.BUCKETS, quality_model.DIMS))
    for t in texts:
        buf = np.frombuffer((t or "").encode(), np.uint8)
        b = quality_model.bucket(quality_model.tokens(buf, np.array([0, len(buf)]))[0]).tolist()
        for i, word in enumerate(b):
            for j in range(max(0, i - quality_model.REACH), min(len(b), i + quality_model.REACH + 1)):
                if i != j:
                    out[word, plus[b[j]]] += 1
                    out[word, minus[b[j]]] -= 1
    out = np.sign(out) * np.log1p(np.abs(out))
    used = out.any(axis=1)
    out[used] -= out[used].mean(axis=0)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    got = quality_model.word_vectors(odd(spark, list(enumerate(texts))).repartition(3))
    assert used.sum() > 5 and np.allclose(got, out, atol=1e-6)


def test_ftrl_finds_the_words_that_matter():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(600):
        x = rng.choice(5000, 60, replace=False) + 100
        bad = k % 6 == 0
        rows.append(np.unique(np.concatenate([x, [k // 6 % 10]]) if bad else x))
        labels.append(float(bad))
    model = toxicity.ftrl(rows, np.array(labels))
    weight = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert all(weight[k] > 1 for k in range(10)) and len(weight) < 500  # of some 5000


@pytest.mark.parametrize("markers", [1, 3])
def test_ftrl_finds_markers_of_a_third_of_all_documents(markers):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(900):
        x = rng.choice(5000, 60, replace=False) + 100
        bad = k % 3 == 0
        rows.append(np.unique(np.append(x, k // 3 % markers) if bad else x))
        labels.append(float(bad))
    model = toxicity.ftrl(rows, np.array(labels))
    weight = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert all(weight.get(k, 0) > 1 for k in range(markers))


def test_held_out_when_a_third_of_the_sample_is_toxic(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = fold("doc_id", 3) == 1
    sample = labels.where(~held & ((F.col("toxic") == 1) | (F.pmod(F.xxhash64("doc_id"), F.lit(100)) < 26)))
    assert 0.3 < sample.agg(F.avg("toxic")).first()[0] < 0.4
    model = toxicity.fit(docs, sample, F.lit(True))
    out = toxicity.scored(docs, model).where(held).join(labels, "doc_id").select("score", "toxic").toPandas()
    assert auc(out.score.to_numpy(), out.toxic.to_numpy()) > 0.97


def test_pooling_matches_a_plain_loop():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(quality_model.BUCKETS, quality_model.DIMS)).astype(np.float32)
    texts = ["", "One two, two!", " ", "x", "café *** ok"]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    w, at = quality_model.tokens(buf, offs)
    assert np.diff(at).tolist() == [0, 5, 0, 1, 3]
    out = quality_model.pooled(vectors, buf, offs)
    for k in range(len(texts)):
        own = w[at[k] : at[k + 1]]
        v = vectors[quality_model.bucket(own)].astype(np.float64)
        if not len(own):
            assert not out[k].any()
            continue
        d = quality_model.DIMS
        near = (v[:-1] * v[1:]).sum(axis=0) / max(len(own) - 1, 1)
        assert np.allclose(out[k, :d], v.mean(axis=0), atol=1e-4) and np.allclose(out[k, d : 2 * d], v.std(axis=0), atol=1e-3)
        assert np.allclose(out[k, 2 * d : 3 * d], near, atol=1e-4)
        assert np.isclose(out[k, -2], len(set(own.tolist())) / len(own)) and np.isclose(out[k, -3], np.log1p(len(own)))


def test_pooling_in_blocks(monkeypatch):
    """Texts longer than a block have the figures of a pass over whole texts, wherever they stand."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(quality_model.BUCKETS, quality_model.DIMS)).astype(np.float32)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50, size)) for size in (3, 40, 0, 7, 8, 100, 1, 5, 16, 17, 2)]

    def run(texts):
        raw = [t.encode() for t in texts]
        return quality_model.pooled(vectors, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))

    whole = run(texts)
    monkeypatch.setattr(quality_model, "BLOCK", 8)
    cut = run(texts)
    assert np.allclose(cut, whole, atol=1e-4)
    assert (run(texts[::-1])[::-1] == cut).all()


def test_hashes_do_not_depend_on_place():
    text = "alpha beta alpha été beta".encode()
    buf = np.frombuffer(text * 2, np.uint8)
    w, at = ts.word_hashes(buf, np.array([0, len(text), 2 * len(text)]))
    assert np.diff(at).tolist() == [5, 5] and (w[:5] == w[5:]).all() and w[0] == w[2] and len(set(w.tolist())) == 3
    g = ts.run_hashes(w, 3)
    assert (g[0:3] == g[5:8]).all()
