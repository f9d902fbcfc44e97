"""The daily models: raw feeds -> detail, summary, attribute and campaign tables.

Each model is a pure function of DataFrames.  Output columns follow the
contracts in SURVEY §2.1.  Plan notes per model sit in the docstrings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewgrid.functions import decode, text
from viewgrid.functions.timefn import seconds_between
from viewgrid.operators.agg import count_entries, count_maps, flat_list, str_list
from viewgrid.operators.device_state import DeviceState
from viewgrid.operators.enrich import bounded_broadcast, left_enrich, with_timezone
from viewgrid.operators.incremental import Window, apply_window
from viewgrid.operators.topn import first_by, last_by

DAILY_KEYS = ["PARTITION_DATE", "AKKIO_ID"]
MIN_CONTENT_SECONDS = 10


# --------------------------------------------------------------------------
# content
# --------------------------------------------------------------------------
def content_detail(content: DataFrame, genre_map: DataFrame, tz_map: DataFrame,
                   window: Window | None = None, min_seconds: int = MIN_CONTENT_SECONDS) -> DataFrame:
    """Viewing sessions longer than ``min_seconds``, cleaned, genre + tz enriched.

    Plan: the window, NULL-id/title and duration filters run in the scan stage
    (date filter -> parquet PartitionFilters); the genre map (one row per
    episode) is a size-checked broadcast, as is the device time-zone map within the
    device bounds.  No aggregation, so the only shuffle is the tz join of more
    devices than that (none if AQE broadcasts it).
    """
    secs = seconds_between("ts_start", "ts_end")
    c = apply_window(content, "date_partition", window)
    c = (c.filter(F.col("show_title").isNotNull() & F.col("hash").isNotNull())
         .withColumn("__secs", secs)
         .filter(F.col("__secs") > min_seconds))
    g = genre_map.select(F.col("episode_id").alias("__ep"), F.col("genre").alias("__genre"))
    c = c.join(bounded_broadcast(g), c["episode_id"] == F.col("__ep"), "left")
    c = with_timezone(c, tz_map)
    return c.select(
        F.col("date_partition").alias("PARTITION_DATE"),
        F.col("date_partition").alias("VIEWED_DATE"),
        F.col("hash").alias("AKKIO_ID"),
        F.col("zipcode").alias("ZIP_CODE"),
        F.col("dma").alias("DMA"),
        F.col("TIMEZONE"),
        text.lower_hyphen("channel_affiliate").alias("NETWORK"),
        text.lower_hyphen("channel_callsign").alias("CALLSIGN"),
        F.col("episode_id").alias("PROGRAM_EPISODE_ID"),
        text.lower_hyphen("show_title").alias("TITLE"),
        text.genre("__genre").alias("GENRE"),
        F.col("air_date").alias("AIR_DATE"),
        F.col("live").alias("WATCHED_LIVE"),
        F.col("ts_start").alias("SESSION_START_TIME_UTC"),
        F.col("ts_end").alias("SESSION_END_TIME_UTC"),
        F.col("__secs").alias("TOTAL_SECONDS"),
        text.upper_hyphen("input_category").alias("INPUT_CATEGORY"),
        text.lower_underscore("input_device").alias("INPUT_DEVICE_NAME"),
        text.lower_hyphen("app_service").alias("APP_SERVICE"),
    )


def content_summary(detail: DataFrame) -> DataFrame:
    """One row per device-day: pick-one location, distinct lists, seconds.

    Plan: a single hash aggregate (partial + final) on (date, device).  All
    list aggregates are collect_set based -- partial buffers hold distinct
    values only, so a hot device-day is combined map-side -- and no Expand is
    planned (DISTINCT aggregates over several columns would multiply rows).
    """
    out = detail.groupBy(*DAILY_KEYS).agg(
        F.max("TIMEZONE").alias("TIMEZONE"),
        F.max("ZIP_CODE").alias("ZIP_CODE"),
        F.max("DMA").alias("DMA"),
        str_list("NETWORK").alias("NETWORK_STR_LIST"),
        str_list("CALLSIGN").alias("CALLSIGN_STR_LIST"),
        str_list("TITLE").alias("TITLE_STR_LIST"),
        flat_list("GENRE").alias("GENRE_STR_LIST"),
        str_list("INPUT_CATEGORY").alias("INPUT_CATEGORY_STR_LIST"),
        str_list("INPUT_DEVICE_NAME").alias("INPUT_DEVICE_STR_LIST"),
        str_list("APP_SERVICE").alias("APP_SERVICE_STR_LIST"),
        F.sum("TOTAL_SECONDS").alias("TOTAL_VIEWING_SECONDS"),
    )
    return out.select("PARTITION_DATE", F.col("PARTITION_DATE").alias("VIEWED_DATE"), "AKKIO_ID",
                      *[c for c in out.columns if c not in DAILY_KEYS])


# --------------------------------------------------------------------------
# commercials
# --------------------------------------------------------------------------
def commercial_detail(ads: DataFrame, category_map: DataFrame, tz_map: DataFrame,
                      window: Window | None = None, strip_apostrophes: bool = False) -> DataFrame:
    """Ad exposures with positive duration, with prev/next content context.

    Plan: filters in the scan; category and tz map size-checked
    broadcasts, so the wide rows are not shuffled; for a map beyond its bounds they are
    dealt over tasks in number with the input.  ``ip`` is read by the reference but not emitted.
    """
    a = apply_window(ads, "date_partition", window)
    a = a.filter(F.col("hash").isNotNull() & (F.col("duration") > 0))
    a = left_enrich(a, category_map, "value", "value",
                    {"commercial_category": "__category"}, small=True, spread_by=("hash",))
    a = with_timezone(a, tz_map)
    return a.select(
        F.col("date_partition").alias("PARTITION_DATE"),
        F.col("date_partition").alias("VIEWED_DATE"),
        F.col("hash").alias("AKKIO_ID"),
        F.col("zipcode").alias("ZIP_CODE"),
        F.col("dma").alias("DMA"),
        F.col("TIMEZONE"),
        F.col("value").alias("CREATIVE_ID"),
        F.col("ts_start").alias("AD_MATCH_START_TIME_UTC"),
        F.col("ts_end").alias("AD_MATCH_END_TIME_UTC"),
        F.col("duration").try_cast("int").alias("AD_LENGTH"),
        text.brand("brand_name", strip_apostrophes).alias("BRAND_NAME"),
        text.brand("title", strip_apostrophes).alias("AD_TITLE"),
        text.category("__category").alias("COMMERCIAL_CATEGORY"),
        F.col("prev_episode_id").alias("PREV_EPISODE_ID"),
        text.title("prev_title").alias("PREV_TITLE"),
        text.title("next_title").alias("NEXT_TITLE"),
        F.col("prev_ts_start").alias("PREV_CONTENT_START_TIME_UTC"),
        F.col("prev_ts_end").alias("PREV_CONTENT_END_TIME_UTC"),
        text.lower_hyphen("prev_channel_callsign").alias("PREV_CALLSIGN"),
        text.lower_hyphen("prev_network_affiliate").alias("PREV_NETWORK"),
        F.col("next_episode_id").alias("NEXT_EPISODE_ID"),
        F.col("next_ts_start").alias("NEXT_CONTENT_START_TIME_UTC"),
        F.col("next_ts_end").alias("NEXT_CONTENT_END_TIME_UTC"),
        text.lower_hyphen("next_channel_callsign").alias("NEXT_CALLSIGN"),
        text.lower_hyphen("next_network_affiliate").alias("NEXT_NETWORK"),
        F.col("live").alias("LIVE"),
        F.col("input_category").alias("INPUT_CATEGORY"),
        text.lower_underscore("input_device").alias("INPUT_DEVICE_NAME"),
        text.lower_hyphen("app_service").alias("APP_SERVICE"),
    )


def commercial_summary(detail: DataFrame, window: Window | None = None) -> DataFrame:
    """Daily per-device ad rollup (one hash aggregate, as content_summary)."""
    d = apply_window(detail, "PARTITION_DATE", window)
    out = d.groupBy(*DAILY_KEYS).agg(
        F.max("TIMEZONE").alias("TIMEZONE"),
        F.max("ZIP_CODE").alias("ZIP_CODE"),
        F.max("DMA").alias("DMA"),
        str_list("CREATIVE_ID").alias("CREATIVE_ID_STR_LIST"),
        str_list("BRAND_NAME").alias("BRAND_NAME_STR_LIST"),
        str_list("AD_TITLE").alias("AD_TITLE_STR_LIST"),
        str_list("COMMERCIAL_CATEGORY").alias("COMMERCIAL_CATEGORY_STR_LIST"),
        str_list("INPUT_CATEGORY").alias("INPUT_CATEGORY_STR_LIST"),
        str_list("INPUT_DEVICE_NAME").alias("INPUT_DEVICE_STR_LIST"),
        str_list("APP_SERVICE").alias("APP_SERVICE_STR_LIST"),
        F.count(F.lit(1)).alias("TOTAL_AD_VIEWS"),
        F.sum("AD_LENGTH").alias("TOTAL_AD_SECONDS"),
    )
    return out.select("PARTITION_DATE", F.col("PARTITION_DATE").alias("VIEWED_DATE"), "AKKIO_ID",
                      *[c for c in out.columns if c not in DAILY_KEYS])


# --------------------------------------------------------------------------
# device activity
# --------------------------------------------------------------------------
FIRST_SESSION_ORDER = ["ts_start", "ts_end", "city", "zipcode"]
LATEST_LOCATION_ORDER = ["date_partition", "ts_start", "ts_end", "city", "zipcode"]


def standard_detail(device: DataFrame, tz_map: DataFrame, window: Window | None = None) -> DataFrame:
    """One row per device-day: first session's location + all seconds of the day.

    The reference computes row_number and a whole-partition SUM window over
    (date, device) and keeps row 1.  Here it is one hash aggregate:
    ``min_by(location, (ts_start, ts_end, city, zipcode))`` + ``sum(seconds)``
    -- same result (ties broken by the extra order columns), partial
    aggregation, no sort, skew-proof.
    """
    d = apply_window(device, "date_partition", window).filter(F.col("hash").isNotNull())
    d = d.withColumn("__secs", seconds_between("ts_start", "ts_end"))
    day = first_by(d, ["date_partition", "hash"], FIRST_SESSION_ORDER,
                   ["city", "iso_state", "dma", "zipcode"],
                   extra_aggs=[F.sum("__secs").alias("__total")])
    day = left_enrich(day, tz_map, "hash", "hash", {"timezone": "TIMEZONE"})
    return day.select(
        F.col("date_partition").alias("PARTITION_DATE"),
        F.col("date_partition").alias("ACTIVITY_DATE"),
        F.col("hash").alias("AKKIO_ID"),
        F.col("TIMEZONE"),
        F.col("__total").alias("TOTAL_SECONDS"),
        F.col("city").alias("CITY"),
        F.col("iso_state").alias("STATE_CODE"),
        F.col("dma").alias("DMA"),
        F.col("zipcode").alias("ZIP_CODE"),
    )


def standard_summary(detail: DataFrame) -> DataFrame:
    """Active devices and seconds per day x state x DMA (planned model)."""
    return detail.groupBy("PARTITION_DATE", "STATE_CODE", "DMA").agg(
        F.count(F.lit(1)).alias("ACTIVE_DEVICES"),
        F.sum("TOTAL_SECONDS").alias("TOTAL_SECONDS"))


def latest_location(device: DataFrame) -> DataFrame:
    """Location of each device's most recent activity (one row per device).

    ``max_by`` over (date, ts_start, ts_end, city, zipcode) instead of a
    row_number window -- see ``operators.topn``.
    """
    d = device.filter(F.col("hash").isNotNull())
    return last_by(d, ["hash"], LATEST_LOCATION_ORDER, ["city", "iso_state", "dma", "zipcode"]).select(
        "hash", "city", F.col("iso_state").alias("state"), "dma", F.col("zipcode").alias("zip_code"))


# --------------------------------------------------------------------------
# demographics
# --------------------------------------------------------------------------
def location_state(spark, root: str) -> DeviceState:
    """The kept form of ``latest_location``: merged day by day, read in place of the device history."""
    return DeviceState(spark, root, "hash", LATEST_LOCATION_ORDER, ["city", "iso_state", "dma", "zipcode"])


def located(state: DataFrame) -> DataFrame:
    """Rows of a ``location_state`` in the shape of ``latest_location``."""
    return state.select("hash", "city", F.col("iso_state").alias("state"), "dma", F.col("zipcode").alias("zip_code"))


def attributes_latest(demo: DataFrame, device: DataFrame, as_of: dt.date | None = None,
                      with_updated_at: bool = False, locations: DataFrame | None = None) -> DataFrame:
    """One row per device: decoded demographics + latest location.

    ``as_of`` stamps PARTITION_DATE (default: today); DBT_UPDATED_AT (the
    run timestamp) is added only on request so compared outputs stay
    deterministic.  ``locations`` (``located``) spares the scan of ``device``.
    """
    stamp = F.lit(as_of) if as_of is not None else F.current_date()
    a = demo.filter(F.col("hash").isNotNull()).select(
        F.col("hash").alias("AKKIO_ID"), *decode.decoded_columns())
    loc = latest_location(device) if locations is None else locations
    a = a.join(loc, a["AKKIO_ID"] == loc["hash"], "left")
    cols = [
        stamp.alias("PARTITION_DATE"),
        F.col("AKKIO_ID"),
        F.col("AKKIO_ID").alias("TV_ID"),
        F.col("AKKIO_ID").alias("AKKIO_HH_ID"),
        "GENDER", "AGE", "AGE_BUCKET",
        F.col("state").alias("STATE"),
        F.lpad(F.col("zip_code").cast("string"), 11, "0").alias("ZIP11"),
        F.lit(None).cast("string").alias("COUNTY_NAME"),
        F.col("city").alias("CITY"),
        F.col("dma").alias("DMA_NAME"),
        "EDUCATION_LEVEL", "ETHNICITY", "SPANISH_LANGUAGE", "MARITAL_STATUS",
        "HOME_OWNERSHIP", F.col("HOME_OWNERSHIP").alias("HOMEOWNER"),
        "HOUSEHOLD_INCOME_K", F.col("HOUSEHOLD_INCOME_K").alias("INCOME"), "INCOME_BUCKET",
        F.lit(None).cast("bigint").alias("NET_WORTH"),
        "HAS_BABIES_0_3", "HAS_CHILDREN_0_18", "ADULT_HOUSEHOLD_SIZE",
        "MOVE_LIKELY", "MOVE_RECENT", "LOW_QUALITY_FLAG", "DEMO_INCOMPLETE_FLAG",
    ]
    if with_updated_at:
        cols.append(F.current_timestamp().alias("DBT_UPDATED_AT"))
    return a.select(*cols)


def agg_hh(attributes: DataFrame) -> DataFrame:
    """Household projection (household = device today)."""
    return attributes.select(
        "AKKIO_HH_ID",
        F.lit(1).alias("HH_WEIGHT"),
        F.col("HOME_OWNERSHIP").alias("HOMEOWNER"),
        (F.col("HOUSEHOLD_INCOME_K") * 1000).alias("INCOME"),
        decode.children_flag().alias("PRESENCE_OF_CHILDREN"),
        "INCOME_BUCKET",
        "PARTITION_DATE",
    )


def agg_ind(attributes: DataFrame) -> DataFrame:
    """Individual projection with the audience tool's NULL defaults."""
    return attributes.select(
        "AKKIO_ID", "AKKIO_HH_ID",
        F.lit(1).alias("WEIGHT"),
        F.coalesce("GENDER", F.lit("UNDETERMINED")).alias("GENDER"),
        "AGE", "AGE_BUCKET",
        F.coalesce("ETHNICITY", F.lit("Unknown")).alias("ETHNICITY_PREDICTION"),
        F.coalesce("EDUCATION_LEVEL", F.lit("Unknown")).alias("EDUCATION"),
        F.coalesce("MARITAL_STATUS", F.lit("Unknown")).alias("MARITAL_STATUS"),
        F.coalesce(F.nullif(F.col("STATE"), F.lit("")), F.lit("Unknown")).alias("STATE"),
        F.col("HOME_OWNERSHIP").alias("HOMEOWNER"),
        (F.col("HOUSEHOLD_INCOME_K") * 1000).alias("INCOME"),
        "INCOME_BUCKET",
        F.right(F.col("ZIP11"), F.lit(5)).alias("ZIP_CODE"),
        F.coalesce(F.col("NET_WORTH").cast("string"), F.lit("Unknown")).alias("NET_WORTH_BUCKET"),
        F.lit(0).alias("MAIDS"), F.lit(0).alias("IPS"), F.lit(0).alias("EMAILS"), F.lit(0).alias("PHONES"),
        "PARTITION_DATE",
    )


# --------------------------------------------------------------------------
# media maps
# --------------------------------------------------------------------------
def media_categories() -> dict:
    """Category family -> expression (string or array of strings) per detail row."""
    genre_tokens = F.transform(
        F.split(F.coalesce(F.col("GENRE"), F.lit("unknown")), ","),
        lambda g: F.coalesce(F.nullif(F.trim(g), F.lit("")), F.lit("unknown")))
    return {
        "TITLES_WATCHED": F.coalesce(F.col("TITLE"), F.lit("unknown")),
        "GENRES_WATCHED": genre_tokens,
        "NETWORKS_WATCHED": F.coalesce(F.col("NETWORK"), F.lit("unknown")),
        "INPUT_DEVICES_USED": F.coalesce(F.col("INPUT_DEVICE_NAME"), F.col("INPUT_CATEGORY"), F.lit("unknown")),
        "APP_SERVICES_USED": F.coalesce(F.col("APP_SERVICE"), F.lit("unknown")),
    }


def agg_media(detail: DataFrame) -> DataFrame:
    """Per device-day maps category -> session count for five families.

    Single pass (tag + explode + two-level aggregate) instead of five group-bys
    joined back on (date, device); see ``operators.agg.count_maps``.
    """
    maps = count_maps(detail, DAILY_KEYS, media_categories())
    return maps.select("PARTITION_DATE", "AKKIO_ID", F.lit(1).alias("INSCAPE_WEIGHT"),
                       "TITLES_WATCHED", "GENRES_WATCHED", "NETWORKS_WATCHED",
                       "INPUT_DEVICES_USED", "APP_SERVICES_USED")


def agg_media_entries(detail: DataFrame) -> DataFrame:
    """Long form of agg_media: (date, device, family, category, sessions)."""
    return count_entries(detail, DAILY_KEYS, media_categories())


def agg_media_by_joins(detail: DataFrame) -> DataFrame:
    """The literal form: five group-bys joined on (date, device).  For tests."""
    src = detail.select("PARTITION_DATE", "AKKIO_ID", "TITLE", "GENRE", "NETWORK",
                        "INPUT_DEVICE_NAME", "INPUT_CATEGORY", "APP_SERVICE")
    base = src.select(*DAILY_KEYS).distinct()
    out = base
    for name, expr in media_categories().items():
        k = F.explode(expr) if name == "GENRES_WATCHED" else expr
        counts = src.select(*DAILY_KEYS, k.alias("k")).groupBy(*DAILY_KEYS, "k").agg(F.count(F.lit(1)).alias("v"))
        m = counts.groupBy(*DAILY_KEYS).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias(name))
        out = out.join(m, DAILY_KEYS, "left")
    return out.select("PARTITION_DATE", "AKKIO_ID", F.lit(1).alias("INSCAPE_WEIGHT"),
                      *media_categories().keys())


# --------------------------------------------------------------------------
# campaigns
# --------------------------------------------------------------------------
def campaign(impressions: DataFrame, population: DataFrame, tz_map: DataFrame,
             attributes: DataFrame, with_ue: bool = False, window: Window | None = None) -> DataFrame:
    """Campaign impressions + market population + time zone + device location.

    One function serves both campaigns; ``with_ue`` adds MARKET_UE_POPULATION.
    Plan: population (one row per market) size-checked broadcast; tz map and
    attributes (device-sized) via AQE -- only DMA_NAME/CITY/STATE are read
    from the attributes, Catalyst prunes the decode work to those columns.
    """
    day = F.to_date("imp_ts")
    i = impressions.filter(F.col("hashed_tvid").isNotNull())
    i = apply_window(i, day, window)
    pop_cols = {"inscape_tv_population": "MARKET_TV_POPULATION"}
    if with_ue:
        pop_cols["ue_population"] = "MARKET_UE_POPULATION"
    i = left_enrich(i, population, "market", "market", pop_cols, small=True)
    i = left_enrich(i, tz_map, "hashed_tvid", "hash", {"timezone": "TIMEZONE"})
    i = left_enrich(i, attributes, "hashed_tvid", "AKKIO_ID",
                    {"DMA_NAME": "DMA", "CITY": "CITY", "STATE": "STATE_CODE"})
    cols = [
        day.alias("PARTITION_DATE"), day.alias("IMPRESSION_DATE"),
        F.col("hashed_tvid").alias("AKKIO_ID"),
        F.col("imp_ts").alias("IMPRESSION_TIMESTAMP"),
        "TIMEZONE", F.col("zipcode").alias("ZIP_CODE"), F.col("market").alias("MARKET"),
        "DMA", "CITY", "STATE_CODE", "MARKET_TV_POPULATION",
    ]
    if with_ue:
        cols.append("MARKET_UE_POPULATION")
    cols += [
        text.lower_hyphen("station_call_sign").alias("STATION_CALL_SIGN"),
        text.lower_hyphen("channel_affiliate").alias("CHANNEL_AFFILIATE"),
        F.col("local_or_national").alias("LOCAL_OR_NATIONAL"),
        F.col("session_type").alias("SESSION_TYPE"),
        F.col("session_source").alias("SESSION_SOURCE"),
        text.title("show_title").alias("SHOW_TITLE"),
    ]
    return i.select(*cols)
