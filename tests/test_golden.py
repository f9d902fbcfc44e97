"""Golden edge-case rows for the scalar builders and decodes (FIXTURES §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewgrid.functions import decode, text
from viewgrid.functions.ratios import safe_metric
from viewgrid.functions.timefn import local_time, seconds_between
from viewgrid.operators.agg import flat_list, str_list


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_brand_keeps_lone_apostrophe(spark):
    assert one(spark, text.brand, "Wendy's  Old_Spice/A:B|C.D-E") == "wendy's-old-spice-a-b-c-d-e"
    assert one(spark, lambda c: text.brand(c, strip_apostrophes=True), "Wendy's Co") == "wendys-co"
    assert one(spark, text.brand, "A'’B") == "ab"


def test_title_regex(spark):
    assert one(spark, text.title, "Grey's  Anatomy: Pt.2 - A,B") == "grey-s-anatomy-pt-2-a-b"
    assert one(spark, text.title, "It’s-A Show!") == "it-s-a-show!"


def test_category(spark):
    assert one(spark, text.category, "Food / Beverage, Snacks - X") == "food/beverage-snacks-x"


def test_hyphen_rules(spark):
    assert one(spark, text.upper_hyphen, "HD TV") == "HD-TV"
    assert one(spark, text.lower_hyphen, "ABC  Family") == "abc--family"
    assert one(spark, text.lower_underscore, "Xbox_One S") == "xbox_one_s"
    assert one(spark, text.genre, "Drama, Sci Fi") == "drama,sci-fi"


def test_source_class_undoes_hyphen(spark):
    assert one(spark, text.source_class, "HD-TV") == "Linear"
    assert one(spark, text.source_class, "SD TV") == "Linear"
    assert one(spark, text.source_class, "Smart App") == "Streaming"
    assert one(spark, text.source_class, None) is None


def test_seconds_truncate(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 11, 100000)),
                                (dt.datetime(2024, 1, 1, 0, 0, 11), dt.datetime(2024, 1, 1, 0, 0, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(seconds_between("a", "b")).collect()] == [10, -11]


def test_cast_and_pads(spark):
    assert one(spark, lambda c: c.try_cast("int"), 15.9, "double") == 15
    assert one(spark, lambda c: F.lpad(c, 11, "0"), "1234") == "00000001234"
    assert one(spark, lambda c: F.lpad(c, 11, "0"), "123456789012") == "12345678901"
    assert one(spark, lambda c: F.right(F.lpad(c, 11, "0"), F.lit(5)), "02139-1234") == "-1234"


def test_lists(spark):
    df = spark.createDataFrame([("k", "a,b"), ("k", None), ("k", "b,,c"), ("n", None)], "g string, v string")
    got = {r["g"]: (r["f"], r["s"]) for r in df.groupBy("g").agg(flat_list("v").alias("f"), str_list("v").alias("s")).collect()}
    assert got["k"][0] == ",a,b,c"
    assert got["n"] == ("", None)


def test_map_from_entries_duplicate_raises(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        df.agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).collect()


def test_safe_metric(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 5.0), (1.0, 3.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_metric(F.col("a"), F.col("b"))).collect()] == [None, None, 0.33, None]


def test_local_time(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 7, 1, 1, 30), "America/New_York"), (dt.datetime(2025, 7, 1, 1, 30), None)],
                               T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("tz", T.StringType())]))
    got = [r[0] for r in df.select(local_time("ts", "tz")).collect()]
    assert got == [dt.datetime(2025, 6, 30, 21, 30), None]


def test_sha256_normalised_email(spark):
    from viewgrid.plans.audience import norm_email, sha256
    assert one(spark, lambda c: sha256(norm_email(c)), " A@b.com ") == \
        "fb98d44ad7501a959f3f4f4a3f004fe2d9e581ea6207e218c4b02c08a4d75adf"


def test_decodes_first_match(spark):
    cols = {c: None for c in decode.MALE + decode.FEMALE}
    cols.update({"demo_male_45_54": 1, "demo_female_18_24": 2, "income_100_125_hh": 1, "income_200_plus_hh": 1,
                 "edu_college": 1, "edu_high_school": 1, "home_renter_hh": 1, "adult_hh_size": None})
    from viewgrid.sources.fixtures import DEMO_COLUMNS
    row = {c: cols.get(c) for c in DEMO_COLUMNS}
    schema = ", ".join(f"{c} int" for c in DEMO_COLUMNS)
    df = spark.createDataFrame([tuple(row[c] for c in DEMO_COLUMNS)], schema)
    r = df.select(*decode.decoded_columns()).first()
    assert (r.GENDER, r.AGE, r.AGE_BUCKET) == ("M", 18, 1)
    assert (r.HOUSEHOLD_INCOME_K, r.INCOME_BUCKET) == (100, 7)
    assert r.EDUCATION_LEVEL == "College" and r.HOME_OWNERSHIP == 0 and r.ADULT_HOUSEHOLD_SIZE == 0
    empty = spark.createDataFrame([tuple(None for _ in DEMO_COLUMNS)], schema).select(*decode.decoded_columns()).first()
    assert (empty.GENDER, empty.AGE, empty.AGE_BUCKET, empty.INCOME_BUCKET, empty.SPANISH_LANGUAGE) == (None, None, 7, 11, "N")
