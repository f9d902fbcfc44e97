"""The pipeline stage by stage against plain versions, and its registration."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from viewgrid.llm.tables import staged

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        if name != "bpe":
            assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        if name == "near_dedup":
            assert after == {d for d, x in brute.near(before, 5).items() if x[2]}
        elif name == "substring":
            want = brute.substring(before)
            assert after == set(want) and all(len(brute.words(r.text)) == want[r.doc_id][0] - want[r.doc_id][1] for r in rows)
        elif name == "decontamination":
            assert after == {d for d, _ in before} - {d for d, _ in brute.contaminated(before, items)}
        elif name == "bpe":
            assert after == {d for d, _ in before} and all(len(r.ids) == 4 * r.n_tokens for r in rows)


def test_run_and_registration(spark):
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert sorted(int(q[2:].split("_")[0]) for q in queries if q.startswith("op") and q[2].isdigit()) == list(range(1, 14))
    assert corpus_pipeline.run(spark, SF).count() > 100


CLASHING = ["score", "label", "predicted", "hash", "n", "part", "words", "item_id", "component_id", "kept", "tag", "key", "ids", "n_tokens", "pooled", "class", "start", "end", "value", "k"]


def through(spark, docs, name):
    for stage, function in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = staged(function(spark, docs, SF), f"{name}-{stage}")
        if stage != "bpe":
            assert docs.columns == columns
    return docs


def test_empty_table(spark):
    assert through(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), "empty").count() == 0


def test_clashing_columns_and_nulls(spark):
    """Other columns, whatever their names, and rows without text or id change nothing for the rest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.unionByName(spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (None, None)], "doc_id long, text string"), allowMissingColumns=True)
    for k, c in enumerate(c for c in CLASHING if c not in docs.columns):
        odd = odd.withColumn(c, F.lit(k) if k % 2 else F.lit("x"))
    plain = {r.doc_id: r.ids_sha256 for r in through(spark, docs, "plain").collect()}
    got = [(r.doc_id, r.ids_sha256) for r in through(spark, odd, "odd").collect()]
    assert {d: x for d, x in got if d is not None and d < 10**9} == plain
    assert sorted(d for d, _ in got if d is not None and d >= 10**9) == [10**9, 10**9 + 1]
