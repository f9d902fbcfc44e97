"""Registry: audience / identity / activation with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewgrid.plans import audience as AU
from viewgrid.registry.base import cte, project, register
from viewgrid.session import scratch_path

_NORM_EMAIL = "lower(trim(email))"
_NORM_PHONE = "nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '')"

cte("ingested", f"""
SELECT *, CASE WHEN reject_reason IS NULL THEN 'accepted' ELSE 'quarantined' END AS ingest_status FROM (
  SELECT *, nullif(concat_ws(',',
      CASE WHEN client_record_id IS NULL THEN 'missing_id' END,
      CASE WHEN {_NORM_EMAIL} IS NULL OR NOT regexp_matches({_NORM_EMAIL}, '{AU.EMAIL_PATTERN}') THEN 'bad_email' END,
      CASE WHEN zip IS NULL OR NOT regexp_matches(zip, '{AU.ZIP_PATTERN}') THEN 'bad_zip' END), '') AS reject_reason
  FROM fx_first_party)""", "fx_first_party")

cte("id_match", f"""
WITH fp AS (SELECT *, sha256({_NORM_EMAIL}) AS e, sha256({_NORM_PHONE}) AS ph, sha256(lower(trim(maid))) AS m FROM fx_first_party),
reg AS (SELECT tv_id, sha256({_NORM_EMAIL}) AS e, sha256({_NORM_PHONE}) AS ph, sha256(lower(trim(maid))) AS m FROM fx_registration),
seen AS (SELECT ip, hash, count(*) AS n FROM fx_commercial GROUP BY ALL),
by_rule AS (
  SELECT client_record_id, known_tv_id AS e0,
    (SELECT min(tv_id) FROM reg WHERE reg.e = fp.e) AS e1,
    (SELECT min(tv_id) FROM reg WHERE reg.ph = fp.ph) AS e2,
    (SELECT min(tv_id) FROM reg WHERE reg.m = fp.m) AS e3,
    (SELECT min(struct_pack(k := -n, h := hash)).h FROM seen WHERE hash IS NOT NULL AND seen.ip = fp.ip) AS e4
  FROM fp)
SELECT client_record_id, coalesce(e0, e1, e2, e3, e4) AS tv_id,
  CASE WHEN e0 IS NOT NULL THEN 'known_id' WHEN e1 IS NOT NULL THEN 'email' WHEN e2 IS NOT NULL THEN 'phone'
       WHEN e3 IS NOT NULL THEN 'maid' WHEN e4 IS NOT NULL THEN 'ip' ELSE 'unmatched' END AS match_method,
  CASE WHEN e0 IS NOT NULL THEN 1 WHEN e1 IS NOT NULL THEN 2 WHEN e2 IS NOT NULL THEN 3
       WHEN e3 IS NOT NULL THEN 4 WHEN e4 IS NOT NULL THEN 5 END AS match_priority
FROM by_rule""", "fx_first_party", "fx_registration", "fx_commercial")

cte("segments", """
SELECT DISTINCT * FROM (
  SELECT 'sports_fans' AS segment_id, AKKIO_ID FROM content_summary
    WHERE list_contains(string_split(GENRE_STR_LIST, ','), 'sports')
  UNION ALL SELECT 'affluent_households', AKKIO_ID FROM attributes_latest WHERE HOUSEHOLD_INCOME_K >= 100
  UNION ALL SELECT 'streaming_heavy', AKKIO_ID FROM content_detail
    WHERE replace(upper(INPUT_CATEGORY), '-', ' ') NOT IN ('HD TV', 'SD TV') AND INPUT_CATEGORY IS NOT NULL
    GROUP BY AKKIO_ID HAVING count(*) >= 10
  UNION ALL SELECT 'campaign_exposed', AKKIO_ID FROM campaign_nbc
  UNION ALL SELECT 'client_matched', tv_id FROM id_match WHERE tv_id IS NOT NULL)""",
    "content_summary", "attributes_latest", "content_detail", "campaign_nbc", "id_match")

cte("suppressed", """
SELECT s.* FROM segments s WHERE NOT EXISTS (SELECT 1 FROM fx_optout o WHERE o.hash = s.AKKIO_ID)""",
    "segments", "fx_optout")

cte("exported", """
SELECT p.partner, s.segment_id, sha256(concat_ws(':', p.salt, s.AKKIO_ID)) AS hashed_id
FROM suppressed s CROSS JOIN (VALUES ('clean_room', 'test secret 1'), ('social', 'test secret 2'), ('dsp', 'test secret 3')) AS p(partner, salt)""", "suppressed")


#: Stand-ins for the partners' secrets.
SALTS = {p: f"test secret {k}" for k, p in enumerate(AU.PARTNERS, 1)}


def _matches(p):
    graph = AU.contact_graph(p.src.registrations).unionByName(AU.ip_graph(p.src.commercial))
    return AU.id_match(p.src.first_party, graph)


def _segments(p):
    """Segments over marts written once, the way a run leaves them."""
    rules = AU.default_rules()
    p.materialize([r.table for r in rules if r.table != "matches"], scratch_path(p.spark, "segment-marts"))
    return AU.segments(lambda name: _matches(p) if name == "matches" else p.ref(name), rules)


def _staged(df, name):
    """``df`` written once, as segments are between building and use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("dmp_ingest_1pd", "SELECT * FROM ingested", ("ingested",))
def dmp_ingest_1pd(spark, sf):
    """Client file (CSV) -> explicit-schema read -> accepted / quarantined."""
    p = project(spark, sf)
    path = scratch_path(spark, "client_file")
    (p.src.first_party.write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return AU.validate_first_party(AU.read_first_party(spark, path))


@register("dmp_hash_pii", f"""
SELECT client_record_id, sha256({_NORM_EMAIL}) AS email_sha256, sha256({_NORM_PHONE}) AS phone_sha256,
  sha256(trim(zip)) AS zip_sha256 FROM fx_first_party""", ("fx_first_party",))
def dmp_hash_pii(spark, sf):
    return AU.hash_pii(project(spark, sf).src.first_party)


@register("dmp_person_key", f"""
SELECT client_record_id, sha256(k) AS person_key
FROM (SELECT client_record_id, nullif(coalesce({_NORM_EMAIL}, '') || '|' || coalesce({_NORM_PHONE}, '') || '|' || coalesce(trim(zip), ''), '||') AS k
      FROM fx_first_party)""", ("fx_first_party",))
def dmp_person_key(spark, sf):
    return AU.person_key(project(spark, sf).src.first_party)


@register("dmp_id_match", "SELECT * FROM id_match", ("id_match",))
def dmp_id_match(spark, sf):
    return _matches(project(spark, sf))


cte("identity_nodes", f"""
SELECT DISTINCT node, key FROM (
  SELECT 'record:' || client_record_id AS node, unnest([sha256({_NORM_EMAIL}), sha256({_NORM_PHONE}), sha256(lower(trim(maid)))]) AS h,
    unnest(['email', 'phone', 'maid']) AS method FROM fx_first_party WHERE client_record_id IS NOT NULL
  UNION ALL
  SELECT 'device:' || tv_id, unnest([sha256({_NORM_EMAIL}), sha256({_NORM_PHONE}), sha256(lower(trim(maid)))]), unnest(['email', 'phone', 'maid'])
  FROM fx_registration WHERE tv_id IS NOT NULL), LATERAL (SELECT method || ':' || h AS key)""", "fx_first_party", "fx_registration")

cte("identity_graph", """
WITH RECURSIVE e AS (SELECT DISTINCT a.node AS x, b.node AS y FROM identity_nodes a JOIN identity_nodes b USING (key)),
reach(x, y) AS (SELECT DISTINCT node, node FROM identity_nodes UNION SELECT r.x, e.y FROM reach r JOIN e ON e.x = r.y)
SELECT split_part(x, ':', 1) AS kind, regexp_replace(x, '^[a-z]+:', '') AS id, min(y) AS person FROM reach GROUP BY x""", "identity_nodes")


@register("dmp_identity_graph", "SELECT * FROM identity_graph", ("identity_graph",))
def dmp_identity_graph(spark, sf):
    p = project(spark, sf)
    return AU.identity_graph(p.src.first_party, p.src.registrations)


@register("dmp_identity_match", """
SELECT r.id AS client_record_id, r.person,
  (SELECT min(d.id) FROM identity_graph d WHERE d.kind = 'device' AND d.person = r.person) AS tv_id,
  (SELECT count(*) FROM identity_graph d WHERE d.kind = 'device' AND d.person = r.person) AS devices,
  (SELECT count(*) FROM identity_graph d WHERE d.kind = 'record' AND d.person = r.person) AS records
FROM identity_graph r WHERE r.kind = 'record'""", ("identity_graph",))
def dmp_identity_match(spark, sf):
    p = project(spark, sf)
    return AU.identity_match(_staged(AU.identity_graph(p.src.first_party, p.src.registrations), "identity-graph"))


@register("dmp_match_rate", """
SELECT match_method, count(*) AS records,
  round(100 * (CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()), 4) AS match_rate_pct
FROM id_match GROUP BY match_method""", ("id_match",))
def dmp_match_rate(spark, sf):
    return AU.match_rate(_matches(project(spark, sf)))


@register("dmp_segment", "SELECT * FROM segments", ("segments",))
def dmp_segment(spark, sf):
    return _segments(project(spark, sf))


_PAIRS = [("sports_fans", "affluent_households"), ("streaming_heavy", "campaign_exposed"), ("client_matched", "sports_fans")]


@register("dmp_segment_overlap", "\nUNION ALL\n".join(f"""
SELECT '{a}' AS a, '{b}' AS b, count(*) AS a_or_b, count(*) FILTER (has_a AND has_b) AS a_and_b, count(*) FILTER (has_a AND NOT has_b) AS a_not_b
FROM (SELECT AKKIO_ID, bool_or(segment_id = '{a}') AS has_a, bool_or(segment_id = '{b}') AS has_b FROM segments
      WHERE segment_id IN ('{a}', '{b}') GROUP BY AKKIO_ID)""" for a, b in _PAIRS), ("segments",))
def dmp_segment_overlap(spark, sf):
    """Sizes of unions, intersections and differences of segments from device bitmaps."""
    seg = _staged(_segments(project(spark, sf)), "segments")
    return AU.bitmap_sizes(AU.segment_bitmaps(seg, AU.device_numbers(seg)), _PAIRS)


@register("dmp_segment_algebra", """
SELECT 'sports_fans|affluent_households' AS operation, AKKIO_ID FROM (
  SELECT AKKIO_ID FROM segments WHERE segment_id = 'sports_fans'
  UNION SELECT AKKIO_ID FROM segments WHERE segment_id = 'affluent_households')
UNION ALL SELECT 'sports_fans&affluent_households', AKKIO_ID FROM (
  SELECT AKKIO_ID FROM segments WHERE segment_id = 'sports_fans'
  INTERSECT SELECT AKKIO_ID FROM segments WHERE segment_id = 'affluent_households')
UNION ALL SELECT 'sports_fans-affluent_households', AKKIO_ID FROM (
  SELECT AKKIO_ID FROM segments WHERE segment_id = 'sports_fans'
  EXCEPT SELECT AKKIO_ID FROM segments WHERE segment_id = 'affluent_households')""", ("segments",))
def dmp_segment_algebra(spark, sf):
    return AU.segment_algebra(_staged(_segments(project(spark, sf)), "segments"), "sports_fans", "affluent_households")


@register("optout_suppress", "SELECT * FROM suppressed", ("suppressed",))
def optout_suppress(spark, sf):
    p = project(spark, sf)
    return AU.suppress_optouts(_segments(p), p.src.optout)


@register("dmp_export", "SELECT * FROM exported", ("exported",))
def dmp_export(spark, sf):
    """Write per-partner / per-segment directories, read them back."""
    p = project(spark, sf)
    path = scratch_path(spark, "export")
    AU.export(AU.suppress_optouts(_segments(p), p.src.optout), path, SALTS)
    return spark.read.parquet(path).select(F.col("partner").cast("string"), F.col("segment_id").cast("string"),
                                          "hashed_id")


@register("dmp_usage_report", """
WITH size AS (SELECT segment_id, count(*) AS audience_size FROM segments GROUP BY 1),
kept AS (SELECT segment_id, count(*) AS after_optout FROM suppressed GROUP BY 1),
deliv AS (SELECT segment_id, count(DISTINCT partner) AS partners, count(*) AS delivered_ids FROM exported GROUP BY 1),
perf AS (SELECT s.segment_id, count(DISTINCT s.AKKIO_ID) AS reached, count(*) AS impressions
         FROM suppressed s JOIN campaign_nbc c ON c.AKKIO_ID = s.AKKIO_ID GROUP BY 1)
SELECT size.segment_id, audience_size, coalesce(after_optout, 0) AS after_optout, coalesce(partners, 0) AS partners,
  coalesce(delivered_ids, 0) AS delivered_ids, coalesce(reached, 0) AS reached, coalesce(impressions, 0) AS impressions,
  round(CAST(impressions AS DOUBLE) / reached, 4) AS avg_frequency
FROM size LEFT JOIN kept ON size.segment_id = kept.segment_id LEFT JOIN deliv ON size.segment_id = deliv.segment_id
LEFT JOIN perf ON size.segment_id = perf.segment_id""", ("segments", "suppressed", "exported", "campaign_nbc"))
def dmp_usage_report(spark, sf):
    p = project(spark, sf)
    return AU.usage_report(_segments(p), p.src.optout, AU.PARTNERS, p.ref("campaign_nbc"))


@register("dmp_lookalike")
def dmp_lookalike(spark, sf):
    """Model-based expansion of the sports-fan audience (no SQL oracle;
    tests check determinism and that seeds are excluded)."""
    p = project(spark, sf)
    seed = AU.segments(p.ref, [r for r in AU.default_rules() if r.segment_id == "sports_fans"])
    return AU.lookalike(seed, p.ref("agg_ind"), p.ref("content_summary"), p.src.optout)


@register("dmp_lookalike_media")
def dmp_lookalike_media(spark, sf):
    """Expansion of the client's matched customers by demographics, volume and media maps (no SQL oracle).

    ``dmp_lookalike`` goes without the maps: its seeds are defined by a genre, which the maps would only repeat.
    """
    p = project(spark, sf)
    parts = _segments(p)
    return AU.lookalike(parts.where(F.col("segment_id") == "client_matched"), p.ref("agg_ind"), p.ref("content_summary"), p.src.optout, media=p.ref("agg_media"))


@register("dmp_media_features", """
SELECT AKKIO_ID, count(DISTINCT category_type || '=' || category) AS n_features,
  coalesce(string_agg(DISTINCT category_type || '=' || category, '|' ORDER BY category_type || '=' || category), '') AS features
FROM media_entries WHERE category_type IN ('TITLES_WATCHED', 'GENRES_WATCHED', 'NETWORKS_WATCHED') GROUP BY AKKIO_ID""", ("media_entries",))
def dmp_media_features(spark, sf):
    """The look-alike model's media features of every device that watched anything in those maps."""
    x = AU.media_features(project(spark, sf).ref("agg_media")).where(F.size("media") > 0)
    return x.select("AKKIO_ID", F.size("media").cast("long").alias("n_features"), F.array_join(F.array_sort("media"), "|").alias("features"))
