"""Hard negatives, importance resampling and fingerprints, held against plain versions."""

import bisect
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from viewgrid.llm import fingerprints, hard_negatives, importance

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "ONE two", "É é ßx 日本語 " * 3, "x" * 5000, "a-b,c  d\ne", "naïve café " * 40, "\U0001f600 " * 30]


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns named like what the operators use inside."""
    rows = [(d, t, 1, 2, 3, "x", 4, 5.0) for d, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, part int, place int, kind int, words string, rank long, score double")


# hard negatives


@pytest.mark.parametrize("shape", [(0, 3, 2), (1, 1, 1), (33, 64, 70), (65, 33, 101), (100, 129, 257)])
@pytest.mark.parametrize("high", [3, 1 << 20, 1 << 40])
def test_strassen_is_exact_modulo_2_64(shape, high):
    r = np.random.default_rng(sum(shape))
    a, b = r.integers(-high, high, shape[:2]), r.integers(-high, high, shape[1:])
    want = np.zeros((shape[0], shape[2]), np.int64)
    for k in range(shape[1]):
        want += a[:, k, None] * b[k]
    assert (hard_negatives.strassen(a, b) == want).all()


def mined(spark, rows, **more):
    rows = [(k, label, vec, 7, 8.0) for k, label, vec in rows]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, slot int, score double")
    out = hard_negatives.mined(df.repartition(5), F.col("vec_id") % 100 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def random_rows(seed, n, dims, labels=4):
    r = np.random.default_rng(seed)
    return [(k, int(r.integers(labels)), [float(x) for x in (r.normal(0, 0.4, dims) + 0.3).astype(np.float32)]) for k in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 70])
def test_hard_negatives(spark, dims):
    rows = random_rows(dims, 420, dims)
    rows += [(1000 + k, 1, rows[5][2]) for k in range(150)]  # ties: one common vector
    rows += [(None, 1, rows[0][2]), (2000, None, rows[0][2]), (2100, 1, None), (2200, 1, [1.0, None]), (2300, 2, [float("nan")] * dims)]
    rows += [(2400, 2, [float("inf")] * dims), (2500, 3, []), (2600, 0, rows[0][2][:1]), (2700, 99, rows[0][2] + [9.0, -9.0])]
    got = mined(spark, rows)
    assert got == brute.hard_negatives(rows) and len(got) > 100
    assert mined(spark, rows, block_bytes=1 << 10) == got  # blocks of one or two anchors
    assert mined(spark, rows + rows[:300] + rows[:100]) == got  # repeated rows don't fill the lists


def test_hard_negatives_without_rows(spark):
    assert mined(spark, []) == [] == mined(spark, [(1, 1, [1.0])]) == mined(spark, [(100, 1, [1.0])])


def test_rows_that_share_an_id_are_candidates_each(spark):
    rows = [(100, 1, [1.0]), (1, 1, [1.0]), (1, 1, [0.5]), (2, 2, [0.9]), (2, 2, [0.95]), (100, 2, [0.9])]
    assert [r[:1] + r[1:3] + r[4:] for r in mined(spark, rows) if r[0] == 100 and r[4] == 65536] == [(100, 1, 1, 65536, 256 * 243), (100, 1, 2, 65536, 256 * 230)]


def test_components_too_large_for_exact_scores_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(100, 1, [1e9]), (1, 1, [1.0])])


# importance resampling


def test_span_checksums():
    r = np.random.default_rng(1)
    buf = r.integers(0, 256, 300_000).astype(np.uint8)
    sizes = np.concatenate([r.integers(0, 70, 300), [0, 1, 63, 64, 65, 127, 128, 129, 1000, 70_000]])
    starts = r.integers(0, 200_000, len(sizes))
    want = [zlib.crc32(buf[a : a + n].tobytes()) for a, n in zip(starts, sizes)]
    assert importance.span_crcs(buf, starts, starts + sizes).tolist() == want


def test_gains_fall_to_the_floor():
    s, t = np.array([0, 5, 1000]), np.array([3, 0, 10])
    out = importance.gains(s, t)
    for k in range(3):
        exact = 1000 * math.log((t[k] + 1) * (s.sum() + 10_000) / ((s[k] + 1) * (t.sum() + 10_000)))
        assert out[k] == math.floor(exact)


def test_resampled(spark):
    r = random.Random(3)
    rows = list(enumerate(ODD)) + [(None, "many words " * 20), (500, "same text " * 15), (501, "same text " * 15)]
    rows += [(100 + k, " ".join(r.choice(["alpha", "Beta", "gamma-delta", "9é", "z" * 90]) + str(r.randrange(30)) for _ in range(r.randrange(60)))) for k in range(150)]
    target = [(1, "alpha beta alpha1 alpha2"), (2, None), (None, "beta7 beta8")]
    out = importance.resampled(frame(spark, rows).repartition(5), frame(spark, target))
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"], r.n_words) for r in out.collect()}
    assert out.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got == brute.resampled(rows, target)
    assert sorted(x[3] for x in got.values() if x[3]) == list(range(1, len([1 for d, t in rows if d is not None and len(brute.features(t)) > 38]) * 25 // 100 + 1))


def test_resampled_empty_tables_and_repeats(spark):
    none = frame(spark, [])
    assert importance.resampled(none, none).collect() == []
    text = "word " * 30
    rows = importance.resampled(frame(spark, [(7, text)] * 40), none).collect()
    assert len(rows) == 40 and sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 11))


# fingerprints


def beside(spark, rows):
    out = fingerprints.beside_next(frame(spark, rows).repartition(3))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_chosen_grams():
    r = random.Random(1)
    texts = ["".join(r.choice("ab é\U0001f600") for _ in range(n)) for n in [*range(20), 100, 300, 700, 1500, 2000]] + ["a" * 500, "abc" * 100, ""]
    own = fingerprints.Fingerprints(texts)
    for k, t in enumerate(texts):
        assert [(int(e["position"]), int(e["hash"])) for e in fingerprints.entries(own.text(k))] == brute.winnowed(t)


def test_a_long_common_run_shares_an_entry():
    r = random.Random(2)
    for n in (40, 300, 5000, 40_000):
        left, right, both = ("".join(r.choice("abcdefgh ") for _ in range(k)) for k in (n, 2 * n, fingerprints.GRAM + fingerprints.WINDOWS[1] - 1))
        own = fingerprints.Fingerprints([left + both + right, right + both + left])
        shared = own.sets[0] & own.sets[1]
        at = [int(e["position"]) for e in fingerprints.entries(own.text(0)) if int(e["hash"]) in shared]
        assert any(len(left) <= p <= len(left) + len(both) - fingerprints.GRAM for p in at)


def test_beside_next(spark):
    r = random.Random(4)
    rows = list(zip(range(50, 50 + len(ODD)), ODD))
    rows += [(k, " ".join(f"w{r.randrange(500)}" for _ in range(r.randrange(400)))) for k in range(-30, 40)]
    rows += [(None, "no id"), (200, "y " * 200), (201, "y " * 200), (202, "z" * 30000), (10**15, "last " * 50)]
    got = beside(spark, rows)
    assert got == sorted(brute.beside_next(rows, fingerprints), key=repr)
    by = {x[0]: x for x in got}
    assert by[200][3] == by[201][3] and by[201][6] == 1.0
    plain = {x.doc_id: x.fingerprint for x in fingerprints.fingerprints(frame(spark, rows)).collect()}
    assert plain == {d: x[3] for d, x in by.items()}


def test_beside_next_small_and_repeated(spark):
    assert beside(spark, []) == []
    (only,) = beside(spark, [(5, "abc def")])
    assert only[1] == 7 and only[2] == hashlib.sha256(b"abc dab").hexdigest() and only[6] == 1.0
    rows = [(3, "aaa bbb ccc")] * 50 + [(2, "ddd eee fff ggg")] + [(4, "hhh iii")] * 3 + [(3, "other text")] * 20
    got = beside(spark, rows)
    assert len(got) == len(rows)
    for doc_id, text, times in ((3, "aaa bbb ccc", 50), (4, "hhh iii", 3), (3, "other text", 20)):
        itself = hashlib.sha256(fingerprints.edited(text, text).encode()).hexdigest()
        assert sum(x[0] == doc_id and x[2] == itself for x in got) == times - 1


def test_order_is_cut_where_keys_begin(spark):
    rows = [(k, f"text {k}") for k in range(3000)]
    starts = fingerprints._starts(fingerprints._keyed(frame(spark, rows)), 16)
    places = [~s[1] for s in starts]
    assert places[0] == 2999 and places == sorted(places, reverse=True) and 8 <= len(places) <= 16
    sizes = [bisect.bisect_left(range(3000), a) for a in places]
    assert max(a - b for a, b in zip(sizes, [*sizes[1:], 0])) < 1500


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = fingerprints.beside_next(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {x[0]: x for x in brute.beside_next(rows, fingerprints)}
    assert {r.doc_id: tuple(r) for r in got} == want
    near = sorted(r.near_edited for r in got)
    assert near[len(near) // 2] > 0.35 and sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)
