"""Audience, identity and activation work.

First-party client records are validated and hashed, matched to TV devices
through an identity waterfall, combined with viewing and demographics into
rule-based segments, suppressed against the opt-out list and exported per
partner.  Identity inputs are device-keyed tables; all matching is equi-joins
plus one hash aggregate per record (no per-record Python).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewgrid.functions import text
from viewgrid.operators.components import components
from viewgrid.operators.enrich import bounded_broadcast
from viewgrid.session import scratch_path

# Validation patterns for client files.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
ZIP_PATTERN = r"^[0-9]{5}$"

FIRST_PARTY_SCHEMA = T.StructType([
    T.StructField("client_record_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("segment_hint", T.StringType()),
    T.StructField("lifetime_value", T.DoubleType()),
    T.StructField("known_tv_id", T.StringType()),
    T.StructField("maid", T.StringType()),
])

#: Column that holds a line of a client file that doesn't parse under the schema.
CORRUPT = "_corrupt_record"

# Activation partners (export destinations) and match priorities.
PARTNERS = ["clean_room", "social", "dsp"]
MATCH_PRIORITY = {"known_id": 1, "email": 2, "phone": 3, "maid": 4, "ip": 5}


def norm_email(c) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def norm_phone(c) -> Column:
    digits = F.regexp_replace(F.col(c) if isinstance(c, str) else c, "[^0-9]", "")
    return F.nullif(digits, F.lit(""))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


# ------------------------------------------------------------ ingestion
def read_first_party(spark, path: str, fmt: str = "csv") -> DataFrame:
    """Read a client file with an explicit schema (no inference).

    A CSV line that doesn't parse keeps its text in ``_corrupt_record`` and is
    quarantined by ``validate_first_party``; a file whose header isn't the
    declared one is refused.
    """
    if fmt != "csv":
        return spark.read.schema(FIRST_PARTY_SCHEMA).format(fmt).load(path)
    header = spark.read.option("header", "true").csv(path).columns
    if header != FIRST_PARTY_SCHEMA.names:
        raise ValueError(f"client file has header {header}, not {FIRST_PARTY_SCHEMA.names}")
    schema = T.StructType([*FIRST_PARTY_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def validate_first_party(df: DataFrame) -> DataFrame:
    """Add ``ingest_status`` (accepted / quarantined) and ``reject_reason``."""
    e = norm_email("email")
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    reasons = F.concat_ws(",",
                          F.when(corrupt, F.lit("unparsable")),
                          F.when(F.col("client_record_id").isNull(), F.lit("missing_id")),
                          F.when(e.isNull() | ~e.rlike(EMAIL_PATTERN), F.lit("bad_email")),
                          F.when(F.col("zip").isNull() | ~F.col("zip").rlike(ZIP_PATTERN), F.lit("bad_zip")))
    return (df.withColumn("reject_reason", F.nullif(reasons, F.lit("")))
            .withColumn("ingest_status", F.when(F.col("reject_reason").isNull(), F.lit("accepted"))
                        .otherwise(F.lit("quarantined"))).drop(CORRUPT))


def hash_pii(df: DataFrame) -> DataFrame:
    """SHA-256 of normalised e-mail, phone digits and zip."""
    return df.select("client_record_id",
                     sha256(norm_email("email")).alias("email_sha256"),
                     sha256(norm_phone("phone")).alias("phone_sha256"),
                     sha256(F.trim(F.col("zip"))).alias("zip_sha256"))


def person_key(df: DataFrame) -> DataFrame:
    """Encoded person id: SHA-256 over the '|'-joined normalised PII tuple.

    NULL for a record without any PII: such records are not one person.
    """
    parts = [F.coalesce(F.nullif(c, F.lit("")), F.lit("")) for c in (norm_email("email"), norm_phone("phone"), F.trim(F.col("zip")))]
    joined = F.concat_ws("|", *parts)
    return df.select("client_record_id", F.when(joined != "||", sha256(joined)).alias("person_key"))


# ------------------------------------------------------------ identity graph
def _keys(df_cols: dict[str, Column]) -> Column:
    """The (method, key) pairs of a row that have a key."""
    pairs = [F.when(k.isNotNull(), F.struct(F.lit(m).alias("method"), k.alias("key"))) for m, k in df_cols.items()]
    return F.array_compact(F.array(*pairs))


def _contact_keys() -> dict[str, Column]:
    return {"email": sha256(norm_email("email")), "phone": sha256(norm_phone("phone")), "maid": sha256(F.lower(F.trim(F.col("maid"))))}


def contact_graph(registrations: DataFrame) -> DataFrame:
    """(method, key, tv_id) of device registrations (tv_id, email, phone, maid); keys are hashed PII."""
    rows = registrations.select("tv_id", F.inline(_keys(_contact_keys())))
    return rows.groupBy("method", "key").agg(F.min("tv_id").alias("tv_id"))


def ip_graph(ads: DataFrame) -> DataFrame:
    """Best device per IP from ad exposures: most exposures, then smallest id.

    One hash aggregate per (ip, device) and one per ip; a hot IP (carrier
    NAT) is combined map-side.
    """
    per = (ads.filter(F.col("hash").isNotNull() & F.col("ip").isNotNull())
           .groupBy("ip", "hash").agg(F.count(F.lit(1)).alias("n")))
    best = F.min_by("hash", F.struct(-F.col("n"), F.col("hash"))).alias("tv_id")
    return per.groupBy(F.lit("ip").alias("method"), F.col("ip").alias("key")).agg(best)


def id_match(first_party: DataFrame, graph: DataFrame) -> DataFrame:
    """Waterfall: known id > e-mail > phone > mobile ad id > IP; one row per client record.

    A record is spread over the keys it has, which are joined with ``graph``
    (method, key, tv_id) at once; the best match per record is chosen by
    ``min_by`` (priority, tv_id) -- a hash aggregate, not a window.  Records
    with no candidate are kept with ``match_method = 'unmatched'``.
    """
    keys = _keys({"known_id": F.col("known_tv_id"), **_contact_keys(), "ip": F.col("ip")})
    rows = first_party.select("client_record_id", F.inline_outer(keys)).join(graph, ["method", "key"], "left")
    prio = F.create_map(*[x for k, v in MATCH_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    rows = rows.withColumns({"tv_id": F.when(F.col("method") == "known_id", F.col("key")).otherwise(F.col("tv_id")),
                             "match_priority": prio[F.col("method")]})
    hit = F.when(F.col("tv_id").isNotNull(), F.struct("match_priority", "tv_id", "method"))
    best = rows.groupBy("client_record_id").agg(F.min(hit).alias("b"))
    return best.select("client_record_id", F.col("b.tv_id").alias("tv_id"),
                       F.coalesce(F.col("b.method"), F.lit("unmatched")).alias("match_method"),
                       F.col("b.match_priority").alias("match_priority"))


def identity_nodes(first_party: DataFrame, registrations: DataFrame) -> DataFrame:
    """(node, key): every client record ('record:<id>') and registered device ('device:<id>') with each contact key it has.

    Keys are hashed PII by method; an IP address is none, as households and carriers share it.
    """
    def side(df: DataFrame, kind: str, id_col: str) -> DataFrame:
        node = F.concat(F.lit(f"{kind}:"), F.col(id_col))
        return df.where(F.col(id_col).isNotNull()).select(node.alias("node"), F.inline_outer(_keys(_contact_keys()))).select(
            "node", F.concat_ws(":", F.lit("key"), "method", "key").alias("key"), F.col("method").isNotNull().alias("has_key"))

    rows = side(first_party, "record", "client_record_id").unionByName(side(registrations, "device", "tv_id"))
    return rows.select("node", F.when(F.col("has_key"), F.col("key")).alias("key")).distinct()


def identity_graph(first_party: DataFrame, registrations: DataFrame) -> DataFrame:
    """(kind, id, person): records and devices that share an e-mail, phone or mobile ad id, directly or through others, are one person.

    A key is a node that its holders are linked to, so a phone number that many hold is a
    star and never pairs.  ``person`` is the least 'device:<id>' or 'record:<id>' of the component; who has
    no key is a person of their own.
    """
    nodes = identity_nodes(first_party, registrations)
    path = scratch_path(nodes.sparkSession, "identity-nodes")
    nodes.write.parquet(path)
    nodes = nodes.sparkSession.read.schema(nodes.schema).parquet(path)
    found = components(nodes.where("key is not null"), "node", "key")
    # 'device' < 'key' < 'record': a component's root may be a key where it has no device
    own = found.where(~F.col("node").startswith("key:"))
    person = own.groupBy("component").agg(F.min("node").alias("person"))
    linked = own.join(person, "component").select("node", "person")
    rows = nodes.select("node").distinct().join(linked, "node", "left")
    kind, name = F.split_part("node", F.lit(":"), F.lit(1)), F.regexp_replace("node", "^[a-z]+:", "")
    return rows.select(kind.alias("kind"), name.alias("id"), F.coalesce("person", "node").alias("person"))


def identity_match(graph: DataFrame) -> DataFrame:
    """Per client record: its person, the person's least device (null without one) and how many devices and records it has."""
    device = F.col("kind") == "device"
    persons = graph.groupBy("person").agg(F.min(F.when(device, F.col("id"))).alias("tv_id"), F.count_if(device).alias("devices"), F.count_if(~device).alias("records"))
    records = graph.where(~device).select(F.col("id").alias("client_record_id"), "person")
    return records.join(persons, "person").select("client_record_id", "person", "tv_id", "devices", "records")


def match_rate(matches: DataFrame) -> DataFrame:
    g = matches.groupBy("match_method").agg(F.count(F.lit(1)).alias("records"))
    total = F.sum("records").over(Window.partitionBy(F.lit(0)))  # <= 4 rows
    return g.withColumn("match_rate_pct", F.round(100 * F.try_divide(F.col("records").cast("double"), total), 4))


# ------------------------------------------------------------ segments
@dataclass(frozen=True)
class Rule:
    """Devices of ``table`` whose rows satisfy ``where`` at least ``least_rows`` times form segment ``segment_id``."""

    segment_id: str
    table: str
    where: Column | str
    id_col: str = "AKKIO_ID"
    least_rows: int = 1


def default_rules() -> list[Rule]:
    """The five documented example segments."""
    return [
        Rule("sports_fans", "content_summary", text.csv_contains("GENRE_STR_LIST", "sports", exact=True)),
        Rule("affluent_households", "attributes_latest", "HOUSEHOLD_INCOME_K >= 100"),
        Rule("streaming_heavy", "content_detail", text.source_class("INPUT_CATEGORY") == "Streaming", least_rows=10),
        Rule("campaign_exposed", "campaign_nbc", F.lit(True)),
        Rule("client_matched", "matches", "tv_id IS NOT NULL", id_col="tv_id"),
    ]


def segments(tables, rules: list[Rule] | None = None) -> DataFrame:
    """(segment_id, AKKIO_ID), distinct, of rules over named tables.

    ``tables`` maps a name to a DataFrame (a function or a dict: viewing,
    demographics, campaigns, matched client records).  Rules over one table
    share one scan and one partial aggregate.
    """
    get = tables if callable(tables) else tables.__getitem__
    parts = []
    grouped: dict[tuple[str, str], list[Rule]] = {}
    for r in rules if rules is not None else default_rules():
        grouped.setdefault((r.table, r.id_col), []).append(r)
    for (table, id_col), own in grouped.items():
        hits = [F.when(F.expr(r.where) if isinstance(r.where, str) else r.where, F.lit(r.segment_id)) for r in own]
        long = get(table).select(F.col(id_col).alias("AKKIO_ID"), F.explode(F.array_compact(F.array(*hits))).alias("segment_id"))
        least = F.lit(1)
        for r in own:
            if r.least_rows != 1:
                least = F.when(F.col("segment_id") == r.segment_id, F.lit(r.least_rows)).otherwise(least)
        n = long.groupBy("segment_id", "AKKIO_ID").agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.where(F.col("n") >= least).select("segment_id", "AKKIO_ID"))
    out = reduce(DataFrame.unionByName, parts)
    names = [x for own in grouped.values() for x in {r.segment_id for r in own}]
    return out.distinct() if len(set(names)) < len(names) else out  # a segment with rules over several tables


def segment_algebra(seg: DataFrame, a: str, b: str) -> DataFrame:
    """union / intersect / except of two segments -> (operation, AKKIO_ID), in one pass over the segments.

    A device's membership of both is two flags of one aggregate; the operations
    that hold for it are exploded from them.
    """
    flags = seg.where(F.col("segment_id").isin(a, b)).groupBy("AKKIO_ID").agg(
        F.max(F.col("segment_id") == a).alias("in_a"), F.max(F.col("segment_id") == b).alias("in_b"))
    holds = F.array_compact(F.array(
        F.lit(f"{a}|{b}"),
        F.when(F.col("in_a") & F.col("in_b"), F.lit(f"{a}&{b}")),
        F.when(F.col("in_a") & ~F.col("in_b"), F.lit(f"{a}-{b}"))))
    return flags.select(F.explode(holds).alias("operation"), "AKKIO_ID")


BITS = 8 * 4096  # devices of one bitmap, as bitmap_construct_agg has them


def device_numbers(ids: DataFrame) -> DataFrame:
    """(AKKIO_ID, number): numbers 0, 1, 2 ... for all distinct devices of ``ids``, in the order of their ids.

    A range-partitioned sort and one count for each part; the table is written, so numbers stay.
    """
    spark = ids.sparkSession
    dealt = ids.select("AKKIO_ID").where("AKKIO_ID is not null").distinct().repartitionByRange("AKKIO_ID").sortWithinPartitions("AKKIO_ID")
    dealt = dealt.withColumn("place", F.monotonically_increasing_id())  # part << 33 | index in the part
    path = scratch_path(spark, "device-numbers")
    dealt.select("AKKIO_ID", F.shiftrightunsigned("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("place")).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each part of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return dealt.join(bounded_broadcast(counts), "part").select("AKKIO_ID", (F.col("base") + F.col("place")).alias("number"))


def segment_bitmaps(seg: DataFrame, numbers: DataFrame) -> DataFrame:
    """(segment_id, bucket, bits): the members of each segment, a bitmap for each bucket of ``BITS`` device numbers."""
    rows = seg.join(numbers, "AKKIO_ID").select("segment_id", F.bitmap_bucket_number(F.col("number") + 1).alias("bucket"),
                                                F.bitmap_bit_position(F.col("number") + 1).alias("bit"))
    return rows.groupBy("segment_id", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bitmap_sizes(bitmaps: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(a, b, a_or_b, a_and_b, a_not_b) devices of each pair of named segments, from the bitmaps in one pass.

    What moves is a bitmap of 4 KB for each segment and 32,768 devices, however often the segments overlap.
    """
    names = sorted({n for p in pairs for n in p})
    asked = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs))).alias("pair")
    rows = bitmaps.where(F.col("segment_id").isin(names)).select("segment_id", "bucket", "bits", asked).select("*", "pair.*")
    rows = rows.where((F.col("segment_id") == F.col("a")) | (F.col("segment_id") == F.col("b")))
    both = rows.groupBy("a", "b", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("any"),
        F.when(F.count(F.lit(1)) == 2, F.bitmap_count(F.bitmap_and_agg("bits"))).otherwise(0).alias("both"),
        F.coalesce(F.max(F.when(F.col("segment_id") == F.col("a"), F.bitmap_count("bits"))), F.lit(0)).alias("own"))
    return both.groupBy("a", "b").agg(F.sum("any").alias("a_or_b"), F.sum("both").alias("a_and_b"), F.sum(F.col("own") - F.col("both")).alias("a_not_b"))


def suppress_optouts(df: DataFrame, optout: DataFrame, id_col: str = "AKKIO_ID") -> DataFrame:
    """Drop rows of opted-out devices (left anti join on the device id)."""
    return df.join(optout.select(F.col("hash").alias(id_col)), id_col, "left_anti")


def export_rows(seg: DataFrame, salts: dict[str, str]) -> DataFrame:
    """(partner, segment_id, hashed_id): every segment to every partner.

    ``salts`` holds a secret per partner: ids are hashed with it, so a partner
    can neither join its file with another's nor try all ids.
    """
    if len(set(salts.values())) < len(salts) or not all(salts.values()):
        raise ValueError("every partner needs a secret of its own")
    who = F.array(*[F.struct(F.lit(k).alias("partner"), F.lit(v).alias("salt")) for k, v in salts.items()])
    p = seg.select("segment_id", "AKKIO_ID", F.explode(who).alias("p"))
    return p.select("p.partner", "segment_id", sha256(F.concat_ws(":", "p.salt", "AKKIO_ID")).alias("hashed_id"))


def export(seg: DataFrame, path: str, salts: dict[str, str]) -> None:
    """Write one directory per partner and segment (the pull-model drop)."""
    rows = export_rows(seg, salts).hint("rebalance", "partner", "segment_id")  # even files, hot segments split
    rows.write.mode("overwrite").partitionBy("partner", "segment_id").parquet(path)


def usage_report(seg: DataFrame, optout: DataFrame, partners, exposures: DataFrame) -> DataFrame:
    """Per segment: size, devices left after opt-out, deliveries, and how the campaign reached it.

    One pass over the segments: opt-outs and the per-device exposure counts
    are joined by device, then one aggregate per segment.  ``exposures`` has a
    row per impression (AKKIO_ID).
    """
    out = optout.select(F.col("hash").alias("AKKIO_ID"), F.lit(True).alias("out")).distinct()
    seen = exposures.groupBy("AKKIO_ID").agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("out").isNull()
    g = seg.join(out, "AKKIO_ID", "left").join(seen, "AKKIO_ID", "left").groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("audience_size"),
        F.count_if(kept).alias("after_optout"),
        F.count_if(kept & (F.col("n") > 0)).alias("reached"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("impressions"))
    n = len(partners)
    return g.select(
        "segment_id", "audience_size", "after_optout",
        F.when(F.col("after_optout") > 0, F.lit(n)).otherwise(0).cast("long").alias("partners"),
        (F.col("after_optout") * n).alias("delivered_ids"), "reached", "impressions",
        F.round(F.try_divide(F.col("impressions").cast("double"), F.col("reached")), 4).alias("avg_frequency"))


# ------------------------------------------------------------ look-alike
RANGES = 1024  # score ranges counted in one pass of exact_quantile


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The value of rank ceil(share * n) of a double column; None without values.

    The same value as approxQuantile with error 0, whose summary on the driver
    holds every row.  Each pass here counts the rows of ``RANGES`` equal ranges and
    goes on with the range that holds the rank, so a row per range reaches the
    driver.  The least and the greatest value fall into different ranges, so every
    pass narrows the search until one value is left.
    """
    v = F.col(column)
    values = df.select(v.cast("double").alias(column)).where(v.isNotNull() & ~F.isnan(v))
    n, low, high = values.agg(F.count(F.lit(1)), F.min(v), F.max(v)).first()
    if not n:
        return None
    rank = min(max(math.ceil(share * n), 1), n)
    while low < high:
        place = F.floor((v - F.lit(low)) / F.lit(high - low) * F.lit(float(RANGES)))
        inside = values.where((v >= F.lit(low)) & (v <= F.lit(high)))
        counts = inside.groupBy(F.least(place, F.lit(RANGES - 1)).alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: r["place"]):  # at most RANGES rows
            if rank <= r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


MEDIA_MAPS = ("TITLES_WATCHED", "GENRES_WATCHED", "NETWORKS_WATCHED")
MEDIA_PLACES = 1 << 12  # places of the hashed media features


def _marked(c: str) -> Column:
    """The keys of map column ``c``, each behind the map's name; empty for null."""
    keys = F.transform(F.map_keys(c), lambda k: F.concat(F.lit(f"{c}="), k))
    return F.coalesce(keys, F.array().cast("array<string>"))


def media_features(media: DataFrame) -> DataFrame:
    """(AKKIO_ID, media): the distinct titles, genres and networks of each device, marked by their map.

    ``media`` has the maps of ``agg_media``, one row per device and day.  Sets are combined
    before the shuffle, so a device's days never meet in one task.
    """
    marked = F.concat(*(_marked(c) for c in MEDIA_MAPS))
    return media.select("AKKIO_ID", F.explode_outer(marked).alias("f")).groupBy("AKKIO_ID").agg(F.collect_set("f").alias("media"))


def lookalike_base(seed: DataFrame, ind: DataFrame, content_summary: DataFrame, media: DataFrame | None = None) -> DataFrame:
    """A row per device: demographics, viewing volume, media features and the label (1.0: in the seed audience)."""
    viewing = content_summary.groupBy("AKKIO_ID").agg(
        F.sum("TOTAL_VIEWING_SECONDS").cast("double").alias("seconds"), F.count(F.lit(1)).cast("double").alias("days"))
    base = (ind.select("AKKIO_ID", "GENDER", "AGE_BUCKET", "INCOME_BUCKET", "EDUCATION")
            .join(viewing, "AKKIO_ID", "left").na.fill(0.0, ["seconds", "days"])
            .join(seed.select("AKKIO_ID").distinct().withColumn("label", F.lit(1.0)), "AKKIO_ID", "left")
            .na.fill(0.0, ["label"]))
    if media is None:
        return base
    return base.join(media_features(media), "AKKIO_ID", "left").withColumn("media", F.coalesce("media", F.array().cast("array<string>")))


def lookalike_pipeline(base: DataFrame):
    """Spark ML pipeline over ``lookalike_base``: one-hot demographics, viewing volume and, where ``base`` has them, media
    features hashed to ``MEDIA_PLACES`` sparse places (so the model's size doesn't grow with the titles) -> logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, OneHotEncoder, StringIndexer, VectorAssembler

    cats = ["GENDER", "EDUCATION"]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep", stringOrderType="alphabetAsc")
              for c in cats]
    stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in cats] + ["AGE_BUCKET", "INCOME_BUCKET"],
                                outputCols=[f"{c}_oh" for c in cats] + ["age_oh", "inc_oh"], handleInvalid="keep"))
    hashed = ["media"] if "media" in base.columns else []
    stages += [HashingTF(inputCol=c, outputCol=f"{c}_hashed", numFeatures=MEDIA_PLACES, binary=True) for c in hashed]
    stages.append(VectorAssembler(inputCols=[f"{c}_oh" for c in cats] + ["age_oh", "inc_oh", "seconds", "days"] + [f"{c}_hashed" for c in hashed],
                                  outputCol="features"))
    # many sparse features: fitted until the order in which tasks add their sums no longer shows in the scores
    effort = {"maxIter": 200, "tol": 1e-12} if hashed else {"maxIter": 20}
    stages.append(LogisticRegression(regParam=0.01, standardization=True, **effort))
    return Pipeline(stages=stages)


def lookalike_model(base: DataFrame):
    """``lookalike_pipeline`` fitted on ``base``, written to the shared folder and read back.

    A model fresh from its fit holds a training summary and through that the session, which its
    tasks can't take along once anything has been observed in that session.
    """
    from pyspark.ml import PipelineModel

    path = scratch_path(base.sparkSession, "lookalike-model")
    lookalike_pipeline(base).fit(base).write().save(path)
    return PipelineModel.load(path)


def lookalike(seed: DataFrame, ind: DataFrame, content_summary: DataFrame, optout: DataFrame | None = None,
              top_fraction: float = 0.1, quantile_error: float = 0.0, media: DataFrame | None = None) -> DataFrame:
    """Score every device by similarity to a seed audience; keep the top share.

    ``media`` (``agg_media``) adds what each device watched to the features; leave it out
    where the seed audience is itself defined by what it watched.
    ``quantile_error`` is the rank error allowed for the cut-off (0: exact).
    Devices in ``optout`` are left out of the result.  The joined base is
    written to the shared folder once, as every stage of the fit reads it, and so
    are the scores, which every pass for the cut-off reads.

    The model is ``lookalike_pipeline`` (label = in seed).  The cut-off is one quantile
    of the score (``exact_quantile``: a bounded number of counts on the driver);
    scoring and filtering stay distributed.
    """
    from pyspark.ml.functions import vector_to_array

    base = lookalike_base(seed, ind, content_summary, media)
    path = scratch_path(base.sparkSession, "lookalike-base")
    base.write.parquet(path)
    base = base.sparkSession.read.schema(base.schema).parquet(path)
    model = lookalike_model(base)
    scored = model.transform(base).withColumn("score", vector_to_array("probability")[1])
    scored = scored.filter(F.col("label") == 0).select("AKKIO_ID", "score")
    path = scratch_path(base.sparkSession, "lookalike-scores")
    scored.write.parquet(path)
    scored = base.sparkSession.read.schema(scored.schema).parquet(path)
    if quantile_error:
        cut = next(iter(scored.approxQuantile("score", [1 - top_fraction], quantile_error)), None)
    else:
        cut = exact_quantile(scored, "score", 1 - top_fraction)
    threshold = 1.0 if cut is None else cut
    found = scored.filter(F.col("score") >= threshold).select("AKKIO_ID", F.round("score", 6).alias("score"))
    return found if optout is None else suppress_optouts(found, optout)
