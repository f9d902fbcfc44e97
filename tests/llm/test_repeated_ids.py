"""Substring removal and near-duplicates where doc_ids repeat, keys clash or groups are large."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import brute
from viewgrid.llm import near_dedup, substring


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def test_substring_tells_apart_all_texts_of_one_doc_id(spark):
    passage = " ".join(prose(0, 25))
    rows = [(7, " ".join(f"own{k}-{i}" for i in range(30)) + " " + passage) for k in range(1, 5001)] + [(8, passage + " tail"), (None, passage)]
    got = substring.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert len(got) == len(rows)
    of_seven = [r for r in got if r.doc_id == 7]
    assert sorted(r.n_removed for r in of_seven) == [0] + [25] * 4999
    whole = {hashlib.sha256(t.encode()).hexdigest() for d, t in rows if d == 7}
    cut = {hashlib.sha256(" ".join(t.split()[:30]).encode()).hexdigest() for d, t in rows if d == 7}
    assert {r.kept_sha256 for r in of_seven if not r.n_removed} < whole and {r.kept_sha256 for r in of_seven if r.n_removed} < cut
    assert [r.n_removed for r in got if r.doc_id == 8] == [25] and [r.n_removed for r in got if r.doc_id is None] == [0]


def test_tags_are_0_unless_a_doc_id_has_several_texts(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (2, "c"), (3, None), (3, ""), (None, "d"), (None, "e")]
    got = substring.tagged(spark.createDataFrame([(t, d, 5) for d, t in rows], "text string, doc_id int, tag int")).collect()
    tags = {}
    for r in got:
        tags.setdefault((r.doc_id, r.text), set()).add(r.tag)
    assert all(len(x) == 1 for x in tags.values()) and len(got) == len(rows) and all(r.rest.tag == 5 for r in got)
    assert tags[1, "a"] == tags[None, "d"] == tags[None, "e"] == {0}
    assert tags[2, "b"] != tags[2, "c"] and tags[3, None] != tags[3, ""]


def test_windows_with_one_key_are_no_repeats_of_each_other():
    key = np.array([5, 5, 5, 9, 9], np.int64)
    sub = np.array([1, 1, 2, 4, 4], np.int64)
    doc = np.array([10, 11, 12, 13, 14], np.int64)
    none, one = np.zeros(5, np.int64), np.ones(5, np.int64)
    batch = substring.rows(key.view(np.uint64), sub.view(np.uint64), doc, none, one, one * 21, substring.MEMBER)
    (out,) = substring._settle(iter([batch]))
    found = set(zip(out.column("doc_id").to_pylist(), out.column("unsettled").to_pylist()))
    assert found == {(11, False), (10, True), (12, True), (14, False)}  # 12 has the key of 10 and 11, but another text


def test_spans_of_a_text_in_many_rows_stay_few(spark):
    text = " ".join(prose(1, 60))
    rows = [(k, text) for k in range(400)] + [(1000 + k, " ".join(prose(k, 10) + text.split()[k % 30 : k % 30 + 30])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    spans = substring.repeated_spans(docs).collect()
    assert len(spans) == 699 and max(len(r.starts) for r in spans) <= 60
    assert all(len(set(r.starts)) == len(r.starts) for r in spans)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(docs).collect()}
    assert got == brute.substring(rows)


def near(spark, rows, **more):
    df = spark.createDataFrame([(t, "x", d, 4) for d, t in rows], "text string, tag string, doc_id long, node int")
    kept = near_dedup.one_of_each(df.repartition(3), **more)
    assert kept.columns == ["text", "tag", "doc_id", "node"]
    groups = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.groups(df, **more).collect() if r.doc_id is not None)
    return sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr), groups


def test_a_text_that_is_nobodys_copy_stays(spark):
    a, b = " ".join(prose(1, 40)), " ".join(prose(2, 40))
    kept, groups = near(spark, [(2, b), (5, a), (5, b)])
    assert kept == [(2, b), (5, a)]
    assert groups == [(2, 36, 2, True), (5, 36, 2, False), (5, 36, 5, True)]


def test_near_copies_under_one_doc_id(spark):
    a = prose(1, 200)
    almost, other = " ".join(a[:-1] + ["end"]), " ".join(prose(3, 50))
    a = " ".join(a)
    kept, groups = near(spark, [(5, a), (5, almost), (5, a), (5, other), (9, almost), (4, None), (4, ""), (None, a)])
    assert [x for x in kept if x[0] is None or x[0] == 4] == [(4, ""), (4, None), (None, a)]
    texts = [t for d, t in kept if d == 5]
    assert other in texts and set(texts) - {other} in ({a}, {almost}) and not [d for d, _ in kept if d == 9]
    assert {x[2] for x in groups if x[0] in (5, 9)} == {5}


def test_a_third_of_all_rows_is_one_document(spark):
    a = prose(1, 60)
    rows = [(3, " ".join(a))] * 200 + [(k, " ".join(a[:-1] + [f"end{k}"])) for k in range(10, 60)] + [(k, " ".join(prose(k, 40))) for k in range(100, 400)]
    kept, groups = near(spark, rows)
    assert len(kept) == 200 + 300 and sum(x[2] == 3 for x in groups) == 250


def test_blocks_hold_every_pair_of_components_once_and_stay_few(spark):
    sizes = {1: 1000, 2: 1, 3: 4, 4: 45, 5: 3}  # component: members of bucket 7
    rows = [(7, 1000 * c + k, c) for c, n in sizes.items() for k in range(n)] + [(8, k, c) for k, c in enumerate([1] * 30 + [2])]
    now = spark.createDataFrame(rows, "key long, node long, component long")
    got = near_dedup._in_pairs(now, 10).toPandas()
    for key, part in got.groupby("key"):
        members = {(n, c) for k, n, c in rows if k == key}
        met = {}
        for (one, two), block in part.groupby(["one", "two"]):
            left, right = (list(zip(x.node, x.component)) for x in (block[block.block == one], block[block.block == two]))
            pairs = {frozenset((x, y)) for x in left for y in right if x[1] != y[1]}
            for p in pairs:
                met[p] = met.get(p, 0) + 1
        assert set(met.values()) == {1}
        assert set(met) == {frozenset((x, y)) for x in members for y in members if x[1] != y[1]}
    assert len(got[got.key == 8]) <= 3 * 31
    large = [(7, k, 0) for k in range(4000)] + [(7, 9999, 1)]
    moved = near_dedup._in_pairs(spark.createDataFrame(large, "key long, node long, component long"), 10).groupBy("component").count().collect()
    assert {r.component: r["count"] for r in moved}[0] == 4000 and {r.component: r["count"] for r in moved}[1] <= 401
