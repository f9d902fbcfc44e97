"""Audience work without SQL oracles: look-alike and approximate reach."""

import random

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

import __spark_entry__ as E
from conftest import SF_CHECK, SF_SMALL
from viewgrid.plans import audience as AU
from viewgrid.plans.audience import exact_quantile
from viewgrid.plans.project import Project


def test_lookalike_deterministic_and_excludes_seed(spark):
    q = E.queries()["dmp_lookalike"]
    a = q(spark, SF_SMALL)
    b = q(spark, SF_SMALL)
    assert sorted(r.AKKIO_ID for r in a.collect()) == sorted(r.AKKIO_ID for r in b.collect())
    seg = E.queries()["dmp_segment"](spark, SF_SMALL).filter(F.col("segment_id") == "sports_fans")
    assert a.join(seg, "AKKIO_ID").count() == 0


def test_lookalike_by_media_deterministic_and_excludes_seed(spark):
    q = E.queries()["dmp_lookalike_media"]
    a, b = ({r.AKKIO_ID: r.score for r in q(spark, SF_SMALL).collect()} for _ in range(2))
    assert a and a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 2e-6 for k in a)
    seed = {r.AKKIO_ID for r in E.queries()["dmp_segment"](spark, SF_SMALL).filter(F.col("segment_id") == "client_matched").collect()}
    assert seed and not seed & a.keys()


def test_lookalike_in_a_session_that_observed_something(spark):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 5 and E.queries()["dmp_lookalike"](spark, SF_SMALL).count() > 0


def test_exact_quantile_is_the_one_of_spark(spark):
    r = random.Random(4)
    near = [0.3 + k * 2.0**-54 for k in range(300)]
    for values in ([r.random() for _ in range(700)], [0.25] * 50 + [0.5] * 50, near + [1e-300, 0.9], [r.choice([0.1, 0.2, 0.7]) for _ in range(99)] + [None, float("nan")], [0.4]):
        df = spark.createDataFrame([(v,) for v in values], "score double")
        for share in (0.0, 0.1, 0.5, 0.9, 0.999, 1.0):
            assert exact_quantile(df, "score", share) == df.approxQuantile("score", [share], 0.0)[0]
    assert exact_quantile(spark.createDataFrame([], "score double"), "score", 0.9) is None


def test_lookalike_brings_no_score_per_device_to_the_driver(spark, monkeypatch):
    errors, plain = [], DataFrame.approxQuantile
    monkeypatch.setattr(DataFrame, "approxQuantile", lambda self, col, shares, error: errors.append(error) or plain(self, col, shares, error))
    assert E.queries()["dmp_lookalike"](spark, SF_SMALL).count() > 0
    assert 0 not in errors  # with error 0 the summary on the driver holds every row


MAPS = "AKKIO_ID string, TITLES_WATCHED map<string,long>, GENRES_WATCHED map<string,long>, NETWORKS_WATCHED map<string,long>"


def test_media_features_of_odd_maps(spark):
    media = spark.createDataFrame([("a", {"X": 2}, {"X": 1, "Y": 1}, None), ("a", {"X": 1}, {}, {"N": 3}), ("b", None, None, None), ("c", {}, {}, {}), (None, {"Z": 1}, None, None)], MAPS)
    got = {r.AKKIO_ID: sorted(r.media) for r in AU.media_features(media).collect()}
    assert got == {"a": ["GENRES_WATCHED=X", "GENRES_WATCHED=Y", "NETWORKS_WATCHED=N", "TITLES_WATCHED=X"], "b": [], "c": [], None: ["TITLES_WATCHED=Z"]}


def test_a_title_alone_finds_lookalikes(spark):
    r = random.Random(8)
    ids = [f"d{k}" for k in range(400)]
    ind = spark.createDataFrame([(d, r.choice("MF"), r.randrange(1, 8), r.randrange(1, 8), r.choice("AB")) for d in ids], "AKKIO_ID string, GENDER string, AGE_BUCKET int, INCOME_BUCKET int, EDUCATION string")
    viewing = spark.createDataFrame([(d, r.randrange(1000)) for d in ids], "AKKIO_ID string, TOTAL_VIEWING_SECONDS long")
    fans = ids[:100]
    media = spark.createDataFrame([(d, {"Show " + r.choice("ABCDE"): 1, **({"The One": 1} if d in fans else {})}, {"Drama": 1}, None) for d in ids[:390]], MAPS)
    seed = spark.createDataFrame([(d,) for d in fans[:60]], "AKKIO_ID string")
    found = {x.AKKIO_ID for x in AU.lookalike(seed, ind, viewing, top_fraction=40 / 340, media=media).collect()}
    assert found >= set(fans[60:]) and len(found) <= 41
    plain = {x.AKKIO_ID for x in AU.lookalike(seed, ind, viewing, top_fraction=40 / 340).collect()}
    assert len(plain & set(fans[60:])) < 20


def test_media_maps_tell_held_out_seeds_better(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    p = Project(spark, SF_CHECK)
    seen = AU.media_features(p.ref("agg_media")).select("AKKIO_ID", F.explode("media").alias("f")).where("f LIKE 'TITLES%'").cache()
    half = seen.select("AKKIO_ID").distinct().count() / 2
    title = seen.groupBy("f").count().orderBy(F.abs(F.col("count") - half), "f").first().f  # watched by about half of all viewers
    seed, area = seen.where(F.col("f") == title).select("AKKIO_ID"), []
    for media in (None, p.ref("agg_media")):
        base = AU.lookalike_base(seed, p.ref("agg_ind"), p.ref("content_summary"), media).where("days > 0").cache()  # volume alone tells viewers from others
        held = F.pmod(F.xxhash64("AKKIO_ID"), F.lit(4)) == 0
        model = AU.lookalike_model(base.where(~held))
        area.append(BinaryClassificationEvaluator().evaluate(model.transform(base.where(held))))
        base.unpersist()
    seen.unpersist()
    print(area)
    assert area[1] > area[0] + 0.1 and area[1] > 0.9


def test_approx_reach_close_to_exact(spark):
    rows = E.queries()["m_approx_reach"](spark, SF_SMALL).collect()
    assert rows and all(r.within_bound and r.reach > 0 for r in rows)


def test_agg_media_rows_only_query_runs(spark):
    df = E.queries()["agg_media"](spark, SF_SMALL)
    assert df.count() > 0
    assert set(df.columns) >= {"TITLES_WATCHED", "GENRES_WATCHED", "APP_SERVICES_USED"}
