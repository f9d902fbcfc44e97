"""Projections of the driver tables into the shapes of the raw viewing feeds.

The driver tables are not TV data, so every feed the models read (content
sessions, ad exposures, device activity, the mapping tables, campaign
impressions, household demographics) is a deterministic projection of them,
defined in ``FIXTURES.md`` §2.  The Spark side runs the projection through
``spark.sql`` with the source DataFrames bound as parameters (no global temp
views, so several scale factors can coexist in one session).  The DuckDB
spelling of the same projections lives in ``ORACLE_FX`` and is inlined as CTEs
into every oracle query.

Two projections multiply rows by a 3-element constant; Spark expresses that as
``explode(array(0, 1, 2))`` (a generator inside the scan stage) rather than a
join against a VALUES list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.sources.tables import Tables

# The 46 household-demographic count columns of the demographic
# feed, in source order (FIXTURES.md §2.7).
DEMO_COLUMNS = [
    "demo_male_18_24", "demo_male_25_34", "demo_male_35_44", "demo_male_45_54",
    "demo_male_55_64", "demo_male_65_999", "demo_female_18_24", "demo_female_25_34",
    "demo_female_35_44", "demo_female_45_54", "demo_female_55_64", "demo_female_65_999",
    "edu_graduate", "edu_college", "edu_some_college", "edu_high_school",
    "ethnicity_african_american", "ethnicity_asian", "ethnicity_white_non_hispanic",
    "ethnicity_hispanic", "ethnicity_middle_eastern", "ethnicity_native_american",
    "ethnicity_other", "ethnicity_unknown", "language_spanish",
    "marital_status_married", "marital_status_single", "home_owner_hh", "home_renter_hh",
    "income_0_35_hh", "income_35_45_hh", "income_45_55_hh", "income_55_70_hh",
    "income_70_85_hh", "income_85_100_hh", "income_100_125_hh", "income_125_150_hh",
    "income_150_200_hh", "income_200_plus_hh", "babies_0_3_hh", "children_0_18_hh",
    "adult_hh_size", "move_likely_hh", "move_recent_hh", "low_quality", "demo_incomplete",
]

# Moduli of the demographic generator rule.
DEMO_MODULI = [11, 13, 17, 19, 23, 29, 31]


def _device_id(col: str) -> str:
    return f"concat('tv', lpad(CAST({col} AS STRING), 6, '0'))"


_CONTENT = f"""
SELECT CAST(ts AS DATE) AS date_partition,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_device_id('user_id')} END AS hash,
  lpad(CAST(user_id * 37 % 100000 AS STRING), 5, '0') AS zipcode,
  concat('DMA ', CAST(user_id % 12 AS STRING)) AS dma,
  CASE event_id % 5 WHEN 0 THEN 'NBC' WHEN 1 THEN 'ABC Family' WHEN 2 THEN 'FOX Sports 1' WHEN 3 THEN 'CBS' END AS channel_affiliate,
  concat('W', upper(event_type), ' TV') AS channel_callsign,
  concat('EP', CAST(event_id % 40 AS STRING)) AS episode_id,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE concat(upper(event_type), ' Show: Pt.', CAST(event_id % 7 AS STRING)) END AS show_title,
  CAST(ts AS DATE) AS air_date,
  ts AS ts_start, ts + INTERVAL '1' SECOND * CAST(floor(value * 10) AS INT) AS ts_end,
  CASE WHEN event_id % 3 = 0 THEN 't' ELSE 'f' END AS live,
  CASE event_id % 4 WHEN 0 THEN 'HD TV' WHEN 1 THEN 'SD TV' WHEN 2 THEN 'Smart App' END AS input_category,
  CASE event_id % 6 WHEN 0 THEN 'Apple TV' WHEN 1 THEN 'Xbox_One S' WHEN 2 THEN 'Roku' END AS input_device,
  CASE event_id % 7 WHEN 0 THEN 'Prime Video' WHEN 1 THEN 'Hulu' END AS app_service
FROM {{events}}"""

_GENRE = """
SELECT concat('EP', CAST(p_partkey AS STRING)) AS episode_id,
  CASE p_partkey % 4 WHEN 0 THEN 'Sports, Live Event' WHEN 1 THEN 'Drama' WHEN 2 THEN 'Drama, Sci Fi, Action' ELSE NULL END AS genre
FROM {part} WHERE p_partkey % 5 <> 4"""

_TIMEZONE = f"""
SELECT DISTINCT {_device_id('user_id')} AS hash,
  CASE user_id % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' ELSE 'America/Los_Angeles' END AS timezone
FROM {{events}} WHERE user_id % 10 <> 9"""

# body of the ad feed; {src} is the (event x k) relation, {part} the part table
_COMMERCIAL_BODY = f"""
SELECT CAST(e.ts AS DATE) AS date_partition,
  CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE {_device_id('e.user_id')} END AS hash,
  concat('10.0.', CAST(e.user_id % 200 AS STRING), '.', CAST(e.event_id % 3 AS STRING)) AS ip,
  lpad(CAST(e.user_id * 37 % 100000 AS STRING), 5, '0') AS zipcode,
  concat('DMA ', CAST(e.user_id % 12 AS STRING)) AS dma,
  concat('CR', CAST(p.p_partkey AS STRING)) AS value,
  e.ts + INTERVAL '1' SECOND * CAST(KK * 31 AS INT) AS ts_start,
  e.ts + INTERVAL '1' SECOND * CAST(KK * 31 + (e.event_id + KK) % 31 AS INT) AS ts_end,
  CAST((e.event_id + KK) % 31 - 1 AS DOUBLE) AS duration,
  CASE WHEN p.p_partkey % 9 = 0 THEN concat('Wendy''s ', p.p_brand) ELSE concat(p.p_brand, ' / Co.') END AS brand_name,
  concat(p.p_name, ': ', p.p_type, ' | 15s') AS title,
  concat('EP', CAST(e.event_id % 40 AS STRING)) AS prev_episode_id,
  concat(upper(e.event_type), ' Show: Pt.', CAST(e.event_id % 7 AS STRING)) AS prev_title,
  e.ts - INTERVAL '1' SECOND * CAST(600 AS INT) AS prev_ts_start, e.ts AS prev_ts_end,
  concat('W', upper(e.event_type), ' TV') AS prev_channel_callsign,
  CASE e.event_id % 3 WHEN 0 THEN 'NBC' WHEN 1 THEN 'ABC Family' END AS prev_network_affiliate,
  concat('EP', CAST((e.event_id + 1) % 40 AS STRING)) AS next_episode_id,
  concat('Grey''s Anatomy, Pt.', CAST(e.event_id % 5 AS STRING)) AS next_title,
  e.ts + INTERVAL '1' SECOND * CAST(124 AS INT) AS next_ts_start, e.ts + INTERVAL '1' SECOND * CAST(900 AS INT) AS next_ts_end,
  'KABC TV' AS next_channel_callsign, 'ABC Family' AS next_network_affiliate,
  CASE WHEN e.event_id % 3 = 0 THEN 't' ELSE 'f' END AS live,
  CASE e.event_id % 4 WHEN 0 THEN 'HD TV' WHEN 1 THEN 'SD TV' WHEN 2 THEN 'Smart App' END AS input_category,
  CASE e.event_id % 6 WHEN 0 THEN 'Apple TV' WHEN 1 THEN 'Xbox_One S' WHEN 2 THEN 'Roku' END AS input_device,
  CASE e.event_id % 7 WHEN 0 THEN 'Prime Video' WHEN 1 THEN 'Hulu' END AS app_service
FROM SRC
JOIN {{part}} p ON p.p_partkey = (e.event_id * 7 + KK) % e.n_parts"""

_COMMERCIAL_SPARK = (_COMMERCIAL_BODY
                     .replace("KK", "e.k")
                     .replace("SRC", "(SELECT ev.*, (SELECT max(p_partkey) + 1 FROM {part}) AS n_parts, explode(array(0, 1, 2)) AS k FROM {events} ev) e"))

_CATEGORY = """
SELECT concat('CR', CAST(p_partkey AS STRING)) AS value,
  CASE p_partkey % 3 WHEN 0 THEN 'Food / Beverage, Snacks' WHEN 1 THEN 'Auto - Motive' ELSE concat(p_type, ' Retail') END AS commercial_category
FROM {part} WHERE p_partkey % 6 <> 5"""

_DEVICE = f"""
SELECT CAST(ts AS DATE) AS date_partition,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE {_device_id('user_id')} END AS hash,
  ts AS ts_start, ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) AS ts_end,
  concat('City ', CAST((user_id + event_id) % 20 AS STRING)) AS city,
  CASE user_id % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'IL' WHEN 4 THEN '' END AS iso_state,
  concat('DMA ', CAST(user_id % 12 AS STRING)) AS dma,
  CAST(user_id * 37 % 100000 AS INT) AS zipcode
FROM {{events}}"""


# The device feed with rows that lack a date (a window over a NULL key keeps them).
_DEVICE_UNDATED = """
SELECT CASE WHEN minute(ts_start) % 20 = 7 THEN NULL ELSE date_partition END AS date_partition, hash, ts_start, ts_end
FROM {fx_device}"""


def _demo_select() -> str:
    cols = []
    for i, name in enumerate(DEMO_COLUMNS):
        p = DEMO_MODULI[(i * 3) % 7]
        cols.append(f"CASE (c_custkey * 37 + {i * i + 1}) % {p} WHEN 0 THEN 1 WHEN 1 THEN 2 "
                    f"WHEN 2 THEN NULL ELSE 0 END AS {name}")
    return (f"SELECT {_device_id('c_custkey')} AS hash,\n  " + ",\n  ".join(cols)
            + "\nFROM {customer}")


_DEMO = _demo_select()

_ATTR = f"""
SELECT CASE WHEN event_id % 61 = 0 THEN NULL ELSE {_device_id('user_id')} END AS hashed_tvid,
  ts AS imp_ts, lpad(CAST(user_id * 37 % 100000 AS STRING), 5, '0') AS zipcode,
  CASE WHEN user_id % 13 = 0 THEN 'UNMAPPED' ELSE concat('NATION_', CAST(user_id % 25 AS STRING)) END AS market,
  concat('Grey''s ', event_type, ', Pt.', CAST(event_id % 7 AS STRING)) AS show_title,
  concat('W', upper(event_type), ' TV') AS station_call_sign,
  CASE event_id % 3 WHEN 0 THEN 'NBC' WHEN 1 THEN 'ABC Family' END AS channel_affiliate,
  CASE event_id % 2 WHEN 0 THEN 'local' ELSE 'national' END AS local_or_national,
  CASE event_id % 3 WHEN 0 THEN 'Live' ELSE 'DVR' END AS session_type,
  CASE event_id % 4 WHEN 0 THEN 'HD TV' ELSE 'Smart App' END AS session_source
FROM {{events}} WHERE event_type = 'TYPE'"""

_ATTR_FBFS = _ATTR.replace("'TYPE'", "'click'").replace("'Grey''s '", "'Sunday '")
_ATTR = _ATTR.replace("TYPE", "view")

_POP = """
SELECT n_name AS market, CAST(1000 + n_nationkey * 137 AS BIGINT) AS inscape_tv_population,
  CAST(5000 + n_nationkey * 911 AS BIGINT) AS ue_population FROM {nation}"""

_POP_FBFS = """
SELECT n_name AS market, CAST(900 + n_nationkey * 151 AS BIGINT) AS inscape_tv_population,
  CAST(4000 + n_nationkey * 877 AS BIGINT) AS ue_population FROM {nation} WHERE n_nationkey % 8 <> 7"""

_DENSE_BODY = """
SELECT date_partition, hash, show_title, channel_affiliate,
  ts_start + INTERVAL '1' SECOND * CAST(KK * (200 + 200 * (floor_h % 3)) AS INT) AS ts_start,
  ts_start + INTERVAL '1' SECOND * CAST(KK * (200 + 200 * (floor_h % 3)) + 150 AS INT) AS ts_end
FROM SRC"""

_DENSE_SPARK = (_DENSE_BODY.replace("KK", "k")
                .replace("SRC", "(SELECT c.*, length(show_title) + minute(ts_start) AS floor_h, "
                                "explode(array(0, 1, 2)) AS k FROM {fx_content} c "
                                "WHERE hash IS NOT NULL AND show_title IS NOT NULL)"))

# Our own fixtures for inputs the driver does not provide (FIXTURES.md §2, last
# paragraph): an opt-out list, first-party customer records, ad spend lines.
_OPTOUT = f"""
SELECT {_device_id('user_id')} AS hash, min(CAST(ts AS DATE)) AS optout_date
FROM {{events}} WHERE user_id % 17 = 0
GROUP BY user_id"""

_FIRST_PARTY = f"""
SELECT CAST(c_custkey AS STRING) AS client_record_id,
  CASE WHEN c_custkey % 11 = 0 THEN concat(c_name, ' at example.com')
       ELSE concat(CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE '' END,
         CASE WHEN c_custkey % 2 = 0 THEN upper(replace(c_name, '#', '.')) ELSE lower(replace(c_name, '#', '.')) END,
         '@example.com') END AS email,
  CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE concat('+1-555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END AS phone,
  CASE WHEN c_custkey % 13 = 0 THEN CAST(c_custkey % 10000 AS STRING)
       ELSE lpad(CAST(c_custkey * 37 % 100000 AS STRING), 5, '0') END AS zip,
  concat('10.0.', CAST(c_custkey % 200 AS STRING), '.', CAST(c_custkey % 3 AS STRING)) AS ip,
  c_mktsegment AS segment_hint,
  c_acctbal AS lifetime_value,
  CASE WHEN c_custkey % 7 = 0 THEN {_device_id('c_custkey % 150')} END AS known_tv_id,
  CASE WHEN c_custkey % 6 = 1 THEN concat('AD-', CAST(c_custkey AS STRING)) END AS maid
FROM {{customer}}
UNION ALL
SELECT concat('blank', CAST(n_nationkey AS STRING)), NULL, CASE WHEN n_nationkey % 2 = 0 THEN 'none' END, NULL,
  NULL, NULL, NULL, NULL, NULL
FROM {{nation}}"""

# Device registrations: contact data of device owners, in the identity graph.
_REGISTRATION = f"""
SELECT {_device_id('c_custkey')} AS tv_id,
  CASE WHEN c_custkey % 3 <> 0 THEN concat(replace(c_name, '#', '.'), '@example.com') END AS email,
  CASE WHEN c_custkey % 5 < 2 THEN concat('1 555 ', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END AS phone,
  CASE WHEN c_custkey % 4 < 3 THEN concat('ad-', CAST(c_custkey AS STRING)) END AS maid
FROM {{customer}}"""

_AD_SPEND = """
SELECT concat('CR', CAST(l_partkey AS STRING)) AS value,
  CAST(l_shipdate AS DATE) AS spend_date,
  l_extendedprice * (1 - l_discount) AS cost,
  CAST(l_quantity AS BIGINT) AS clicks,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS conversions,
  l_extendedprice * (1 + l_tax) * CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS revenue,
  CAST(l_quantity AS BIGINT) * 3 AS video_views,
  CAST(l_quantity AS BIGINT) * 3 - l_linenumber AS video_completions
FROM {lineitem}"""

# name -> (spark template, dependencies).  Dependencies are driver tables or
# other fixtures.
FX_SPARK = {
    "fx_content": (_CONTENT, ("events",)),
    "fx_genre": (_GENRE, ("part",)),
    "fx_timezone": (_TIMEZONE, ("events",)),
    "fx_commercial": (_COMMERCIAL_SPARK, ("events", "part")),
    "fx_commercial_category": (_CATEGORY, ("part",)),
    "fx_device": (_DEVICE, ("events",)),
    "fx_device_undated": (_DEVICE_UNDATED, ("fx_device",)),
    "fx_demographics": (_DEMO, ("customer",)),
    "fx_attr": (_ATTR, ("events",)),
    "fx_attr_fbfs": (_ATTR_FBFS, ("events",)),
    "fx_pop": (_POP, ("nation",)),
    "fx_pop_fbfs": (_POP_FBFS, ("nation",)),
    "fx_dense": (_DENSE_SPARK, ("fx_content",)),
    "fx_optout": (_OPTOUT, ("events",)),
    "fx_first_party": (_FIRST_PARTY, ("customer", "nation")),
    "fx_registration": (_REGISTRATION, ("customer",)),
    "fx_ad_spend": (_AD_SPEND, ("lineitem",)),
}


def _duck(template: str) -> str:
    return (template.replace("{events}", "events").replace("{part}", "part")
            .replace("{customer}", "customer").replace("{nation}", "nation")
            .replace("{lineitem}", "lineitem").replace("{fx_content}", "fx_content").replace("{fx_device}", "fx_device"))


# DuckDB spelling (CTE bodies) for the oracle side.
ORACLE_FX = {name: _duck(tpl) for name, (tpl, _) in FX_SPARK.items()}
ORACLE_FX["fx_commercial"] = _duck(
    _COMMERCIAL_BODY.replace("KK", "k.k").replace("SRC", "(SELECT ev.*, (SELECT max(p_partkey) + 1 FROM part) AS n_parts FROM events ev) e CROSS JOIN (VALUES (0), (1), (2)) AS k(k)"))
ORACLE_FX["fx_dense"] = _duck(
    _DENSE_BODY.replace("KK", "k.k").replace(
        "SRC", "(SELECT c.*, length(show_title) + minute(ts_start) AS floor_h FROM fx_content c "
               "WHERE hash IS NOT NULL AND show_title IS NOT NULL) CROSS JOIN (VALUES (0), (1), (2)) AS k(k)"))
FX_DEPS = {name: deps for name, (_, deps) in FX_SPARK.items()}


class Sources:
    """Raw feeds for one scale-factor directory, built lazily and memoised.

    ``Sources(spark, sf_dir)["fx_content"]`` is the content viewing feed.  The
    same object serves every model of one build so each feed's plan is built
    once (Spark still re-reads parquet per action unless a caller persists).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = Tables(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FX_SPARK:
                tpl, deps = FX_SPARK[name]
                self._cache[name] = self.spark.sql(tpl, **{d: self[d] for d in deps})
            else:
                self._cache[name] = self.tables[name]
        return self._cache[name]

    # readable aliases for the feeds (names of the shapes in FIXTURES.md §1)
    content = property(lambda self: self["fx_content"])
    commercial = property(lambda self: self["fx_commercial"])
    device = property(lambda self: self["fx_device"])
    genre_map = property(lambda self: self["fx_genre"])
    tz_map = property(lambda self: self["fx_timezone"])
    category_map = property(lambda self: self["fx_commercial_category"])
    demographics = property(lambda self: self["fx_demographics"])
    impressions = property(lambda self: self["fx_attr"])
    population = property(lambda self: self["fx_pop"])
    impressions_fbfs = property(lambda self: self["fx_attr_fbfs"])
    population_fbfs = property(lambda self: self["fx_pop_fbfs"])
    optout = property(lambda self: self["fx_optout"])
    first_party = property(lambda self: self["fx_first_party"])
    registrations = property(lambda self: self["fx_registration"])
    ad_spend = property(lambda self: self["fx_ad_spend"])


def device_id(c: Column) -> Column:
    """Device id spelling used by all feeds: 'tv' + 6-digit zero-padded id."""
    return F.concat(F.lit("tv"), F.lpad(c.cast("string"), 6, "0"))
