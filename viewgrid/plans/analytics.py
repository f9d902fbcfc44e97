"""Documented analytics over the built tables.

Reach / frequency / share metrics, cross-table questions, session analyses
and ad-cost ratios.  Inputs are model DataFrames; every function is a plain
DataFrame transformation.  Distinct counts are exact (``countDistinct``,
planned by Spark as a two-level hash aggregate, skew-safe);
``approx_reach`` offers the HyperLogLog++ variant for very large reach
questions where ~1-2% error is acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewgrid.functions import text
from viewgrid.functions.ratios import pct, ratio, safe_metric
from viewgrid.functions.timefn import daypart_of, local_time
from viewgrid.operators.sessions import island_summary, with_next
from viewgrid.operators.sweep import bucket_start, buckets_touched, seconds_per_bucket, under_way

CONNECT_GAP_SECONDS = 300      # documented: gaps <= 5 min stay connected
CONSECUTIVE_THRESHOLD = 300    # documented example: 5 consecutive minutes
EFFECTIVE_FREQUENCY = 3        # documented: 3+ exposures
AD_BREAK_GAP_SECONDS = 60      # ours: ads <= 60 s apart belong to one break


# ------------------------------------------------------------ cross-table
def campaign_content(campaign: DataFrame, content_summary: DataFrame) -> DataFrame:
    cs = content_summary.select("AKKIO_ID", "PARTITION_DATE", "GENRE_STR_LIST", "TOTAL_VIEWING_SECONDS")
    j = campaign.join(cs, ["AKKIO_ID", "PARTITION_DATE"], "left")
    return j.select("AKKIO_ID", "PARTITION_DATE", "IMPRESSION_TIMESTAMP",
                    F.col("SHOW_TITLE").alias("impression_context"),
                    F.col("GENRE_STR_LIST").alias("daily_genres_watched"), "TOTAL_VIEWING_SECONDS")


def campaign_demo_reach(campaign: DataFrame, attributes: DataFrame) -> DataFrame:
    a = attributes.select("AKKIO_ID", "AGE_BUCKET", "HOUSEHOLD_INCOME_K")
    j = campaign.select("AKKIO_ID", "MARKET").join(a, "AKKIO_ID", "left")
    return j.groupBy("MARKET", "AGE_BUCKET", "HOUSEHOLD_INCOME_K").agg(
        F.countDistinct("AKKIO_ID").alias("unique_reach"), F.count(F.lit(1)).alias("total_impressions"))


def campaign_coviewing(campaign: DataFrame, commercial_summary: DataFrame) -> DataFrame:
    cs = commercial_summary.select("AKKIO_ID", "PARTITION_DATE", "BRAND_NAME_STR_LIST", "TOTAL_AD_VIEWS")
    j = campaign.join(cs, ["AKKIO_ID", "PARTITION_DATE"], "left")
    return j.select("AKKIO_ID", "PARTITION_DATE", "IMPRESSION_TIMESTAMP",
                    F.col("BRAND_NAME_STR_LIST").alias("other_brands_seen"),
                    F.col("TOTAL_AD_VIEWS").alias("daily_ad_exposure"))


def sports_high_value(attributes: DataFrame, content_summary: DataFrame, min_income_k: int = 100,
                      genre: str = "sports") -> DataFrame:
    cs = content_summary.filter(text.csv_contains("GENRE_STR_LIST", genre))
    a = attributes.filter(F.col("HOUSEHOLD_INCOME_K") >= min_income_k).select(
        "AKKIO_ID", "AGE", "GENDER", "HOUSEHOLD_INCOME_K", "EDUCATION_LEVEL")
    j = a.join(cs.select("AKKIO_ID", "PARTITION_DATE", "TOTAL_VIEWING_SECONDS"), "AKKIO_ID", "inner")
    return j.select("AKKIO_ID", "PARTITION_DATE", "AGE", "GENDER", "HOUSEHOLD_INCOME_K", "EDUCATION_LEVEL",
                    (F.col("TOTAL_VIEWING_SECONDS") / 3600).alias("total_hours"))


def household_viewing(attributes: DataFrame, content_summary: DataFrame) -> DataFrame:
    j = attributes.join(content_summary.select("AKKIO_ID", "TOTAL_VIEWING_SECONDS"), "AKKIO_ID", "inner")
    return j.groupBy("STATE", "DMA_NAME", "INCOME_BUCKET", "HOME_OWNERSHIP").agg(
        F.countDistinct("AKKIO_HH_ID").alias("household_count"),
        F.round(F.avg("TOTAL_VIEWING_SECONDS") / 3600, 6).alias("avg_viewing_hours"))


def individual_audience(ind: DataFrame, age_min: int = 25, age_max: int = 54, min_income: int = 75_000,
                        genders=("M", "F")) -> DataFrame:
    """Documented audience filter; INCOME is in dollars, so the documented
    ``>= 75`` (thousands) is applied as ``>= 75000``."""
    f = ind.filter(F.col("AGE").between(age_min, age_max) & (F.col("INCOME") >= min_income)
                   & F.col("GENDER").isin(*genders))
    return f.select("AKKIO_ID", "GENDER", "AGE", "ETHNICITY_PREDICTION", "INCOME", "WEIGHT")


def genre_by_demo(media: DataFrame, ind: DataFrame) -> DataFrame:
    """Genre preference by age bucket x gender (sessions and viewers)."""
    g = media.select("AKKIO_ID", F.explode("GENRES_WATCHED").alias("genre", "sessions"))
    j = g.join(ind.select("AKKIO_ID", "AGE_BUCKET", "GENDER"), "AKKIO_ID", "inner")
    return j.groupBy("genre", "AGE_BUCKET", "GENDER").agg(
        F.sum("sessions").alias("sessions"), F.countDistinct("AKKIO_ID").alias("viewers"))


def seconds_by_income(content_summary: DataFrame, ind: DataFrame) -> DataFrame:
    j = content_summary.select("AKKIO_ID", "TOTAL_VIEWING_SECONDS").join(
        ind.select("AKKIO_ID", "INCOME_BUCKET"), "AKKIO_ID", "inner")
    return j.groupBy("INCOME_BUCKET").agg(
        F.sum("TOTAL_VIEWING_SECONDS").alias("total_seconds"),
        F.countDistinct("AKKIO_ID").alias("viewers"),
        F.round(F.avg("TOTAL_VIEWING_SECONDS"), 4).alias("avg_daily_seconds"))


def network_by_education(media: DataFrame, ind: DataFrame) -> DataFrame:
    n = media.select("AKKIO_ID", F.explode("NETWORKS_WATCHED").alias("network", "sessions"))
    j = n.join(ind.select("AKKIO_ID", "EDUCATION"), "AKKIO_ID", "inner")
    return j.groupBy("network", "EDUCATION").agg(
        F.sum("sessions").alias("sessions"), F.countDistinct("AKKIO_ID").alias("viewers"))


# ------------------------------------------------------------ reach & frequency
def reach(df: DataFrame, by: list[str], id_col: str = "AKKIO_ID") -> DataFrame:
    return df.groupBy(*by).agg(F.countDistinct(id_col).alias("reach"), F.count(F.lit(1)).alias("views"))


def approx_reach(df: DataFrame, by: list[str], id_col: str = "AKKIO_ID", rsd: float = 0.01) -> DataFrame:
    return df.groupBy(*by).agg(F.approx_count_distinct(id_col, rsd).alias("approx_reach"))


def sketch_check(estimates: DataFrame, exact: DataFrame, by: list[str], estimate: str, count: str, bound: Column) -> DataFrame:
    """(by, exact count, within_bound) of every key that either side has; a key that one side lacks is out of bounds."""
    none = F.lit(None)
    rows = estimates.select(*by, F.col(estimate).cast("double").alias("e"), none.cast("long").alias("n")).unionByName(
        exact.select(*by, none.cast("double").alias("e"), F.col(count).cast("long").alias("n")))
    g = rows.groupBy(*by).agg(F.max("e").alias("e"), F.max("n").alias(count))
    return g.select(*by, count, F.coalesce(F.abs(F.col("e") - F.col(count)) <= bound, F.lit(False)).alias("within_bound"))


def _exposures(ads: DataFrame, by: list[str]) -> DataFrame:
    """Exposures per (by, device) -- the first level of every frequency metric."""
    return ads.groupBy(*by, "AKKIO_ID").agg(F.count(F.lit(1)).alias("exposures"))


def avg_frequency(ads: DataFrame, by=("BRAND_NAME",)) -> DataFrame:
    e = _exposures(ads, list(by))
    return e.groupBy(*by).agg(F.sum("exposures").alias("impressions"), F.count(F.lit(1)).alias("reach")).withColumn(
        "avg_frequency", F.round(ratio(F.col("impressions"), F.col("reach")), 4))


def effective_reach(ads: DataFrame, by=("BRAND_NAME",), min_exposures: int = EFFECTIVE_FREQUENCY) -> DataFrame:
    e = _exposures(ads, list(by))
    return e.groupBy(*by).agg(
        F.count(F.lit(1)).alias("reach"),
        F.count_if(F.col("exposures") >= min_exposures).alias("effective_reach"),
    ).withColumn("effective_reach_pct", F.round(pct(F.col("effective_reach"), F.col("reach")), 2))


def frequency_distribution(ads: DataFrame, by=("BRAND_NAME",)) -> DataFrame:
    e = _exposures(ads, list(by))
    return e.groupBy(*by, "exposures").agg(F.count(F.lit(1)).alias("devices"))


def share_of_voice(ads: DataFrame, by=("BRAND_NAME",), per: tuple = ("PARTITION_DATE",)) -> DataFrame:
    """Brand impressions / all impressions within ``per`` (per day by default).

    The share's denominator is a window over the per-(day, brand) table,
    partitioned by day -- bounded by the number of brands.
    """
    per = list(per)
    g = ads.groupBy(*per, *by).agg(F.count(F.lit(1)).alias("impressions"))
    total = F.sum("impressions").over(Window.partitionBy(*per))
    return g.withColumn("sov_pct", F.round(pct(F.col("impressions"), total), 4))


def live_share(detail: DataFrame, by=("NETWORK",), live_col: str = "WATCHED_LIVE") -> DataFrame:
    is_live = F.col(live_col) == "t"
    return detail.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(is_live).alias("live_sessions"),
        F.sum("TOTAL_SECONDS").alias("seconds"),
        F.sum(F.when(is_live, F.col("TOTAL_SECONDS")).otherwise(0)).alias("live_seconds"),
    ).withColumn("live_pct", F.round(pct(F.col("live_sessions"), F.col("sessions")), 1)).withColumn(
        "time_shifted_pct", F.round(100 - F.col("live_pct"), 1))


def program_transitions(detail: DataFrame, max_gap_seconds: int = CONNECT_GAP_SECONDS) -> DataFrame:
    """Each session with the device's next session, across midnight too.

    ``continued`` = the next session starts within ``max_gap_seconds`` of
    this one's end and is a different program.
    """
    nxt = with_next(detail, ["AKKIO_ID"], "SESSION_START_TIME_UTC",
                    ["SESSION_START_TIME_UTC", "SESSION_END_TIME_UTC", "TITLE"],
                    ["TITLE", "SESSION_START_TIME_UTC"])
    gap = F.timestamp_diff("SECOND", F.col("SESSION_END_TIME_UTC"), F.col("next_SESSION_START_TIME_UTC"))
    cont = F.col("next_TITLE").isNotNull() & (F.col("next_TITLE") != F.col("TITLE")) & (gap <= max_gap_seconds)
    return nxt.withColumn("continued", F.coalesce(cont, F.lit(False)))


def retention(detail: DataFrame, max_gap_seconds: int = CONNECT_GAP_SECONDS) -> DataFrame:
    """Viewers per program and how many continued to a different program.

    Two plain aggregates -- (program, device) then program -- instead of two
    DISTINCT aggregates, which Spark would plan as an Expand (rows x 2).
    """
    t = program_transitions(detail, max_gap_seconds)
    per_dev = t.groupBy("TITLE", "AKKIO_ID").agg(F.max(F.col("continued").cast("int")).alias("c"))
    return per_dev.groupBy("TITLE").agg(
        F.count(F.lit(1)).alias("viewers"),
        F.count_if(F.col("c") == 1).alias("retained_viewers"),
    ).withColumn("retention_pct", F.round(pct(F.col("retained_viewers"), F.col("viewers")), 2))


def lead_in(detail: DataFrame, max_gap_seconds: int = CONNECT_GAP_SECONDS) -> DataFrame:
    t = program_transitions(detail, max_gap_seconds).filter("continued")
    return t.groupBy(F.col("TITLE").alias("lead_in_title"), F.col("next_TITLE").alias("following_title")).agg(
        F.countDistinct("AKKIO_ID").alias("lead_in_viewers"), F.count(F.lit(1)).alias("transitions"))


def cross_network(detail: DataFrame) -> DataFrame:
    """Per network: viewers, viewers seen on no other network, cross viewers.

    Built from the distinct (device, network) set and a per-device network
    count joined back -- no network pairs are materialised.
    """
    dn = detail.select("AKKIO_ID", "NETWORK").filter(F.col("NETWORK").isNotNull()).distinct()
    per_dev = dn.groupBy("AKKIO_ID").agg(F.count(F.lit(1)).alias("n_networks"))
    j = dn.join(per_dev, "AKKIO_ID")
    return j.groupBy("NETWORK").agg(
        F.count(F.lit(1)).alias("viewers"),
        F.count_if(F.col("n_networks") == 1).alias("exclusive_viewers"),
        F.count_if(F.col("n_networks") >= 2).alias("cross_viewers"),
    ).withColumn("cross_pct", F.round(pct(F.col("cross_viewers"), F.col("viewers")), 2))


def segment_affinity(detail: DataFrame, ind: DataFrame, segment: str = "AGE_BUCKET",
                     item: str = "NETWORK") -> DataFrame:
    """Index = (segment viewers of item / segment size) / (item viewers / all devices) x 100.

    Segment sizes are one row per segment (a bounded table: the all-device
    total is a window over it); per-item totals are a window partitioned by
    item over the (item, segment) table.
    """
    seg = ind.select("AKKIO_ID", segment)
    active = detail.select("AKKIO_ID").distinct().join(seg, "AKKIO_ID", "inner")
    seg_size = active.groupBy(segment).agg(F.count(F.lit(1)).alias("segment_devices"))
    viewers = detail.select("AKKIO_ID", item).distinct().join(seg, "AKKIO_ID", "inner")
    by_item_seg = viewers.groupBy(item, segment).agg(F.count(F.lit(1)).alias("segment_viewers"))
    item_viewers = F.sum("segment_viewers").over(Window.partitionBy(item))
    all_devices = F.sum("segment_devices").over(Window.partitionBy(F.lit(0)))
    seg_size = seg_size.withColumn("__all_devices", all_devices)
    j = by_item_seg.join(seg_size, segment, "inner")
    rate_seg = ratio(F.col("segment_viewers"), F.col("segment_devices"))
    rate_all = ratio(item_viewers, F.col("__all_devices"))
    return j.select(item, segment, "segment_viewers", "segment_devices",
                    F.round(100 * ratio(rate_seg, rate_all), 2).alias("affinity_index"))


# ------------------------------------------------------------ ad cost metrics
def creative_totals(ads: DataFrame, spend: DataFrame) -> DataFrame:
    """Per creative: impressions + reach (exposures) and summed spend lines."""
    imp = ads.groupBy("CREATIVE_ID").agg(F.count(F.lit(1)).alias("impressions"),
                                          F.countDistinct("AKKIO_ID").alias("reach"))
    sp = spend.groupBy(F.col("value").alias("CREATIVE_ID")).agg(
        F.round(F.sum("cost"), 4).alias("cost"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.round(F.sum("revenue"), 4).alias("revenue"), F.sum("video_views").alias("video_views"),
        F.sum("video_completions").alias("video_completions"))
    return imp.join(sp, "CREATIVE_ID", "full")


def cost_metrics(t: DataFrame) -> DataFrame:
    """Documented ratios; 0, NULL or non-finite -> NULL, 2 decimals."""
    c = F.col
    return t.select(
        "*",
        safe_metric(c("cost"), c("clicks")).alias("cpc"),
        safe_metric(c("cost") * 1000, c("impressions")).alias("cpm"),
        safe_metric(c("cost"), c("impressions") * 1000).alias("cpm_documented"),
        safe_metric(c("conversions"), c("clicks")).alias("cvr"),
        safe_metric(c("clicks"), c("impressions")).alias("ctr"),
        safe_metric(c("cost"), c("conversions")).alias("cpa"),
        safe_metric(c("cost"), c("video_views")).alias("cpv"),
        safe_metric(c("cost"), c("video_completions")).alias("cpcv"),
        safe_metric(c("video_completions"), c("video_views")).alias("vtr"),
        safe_metric(c("revenue"), c("cost")).alias("roas"),
    )


def ad_cost_metrics(ads: DataFrame, spend: DataFrame) -> DataFrame:
    return cost_metrics(creative_totals(ads, spend))


def ad_cost_totals(ads: DataFrame, spend: DataFrame) -> DataFrame:
    """Averages as ratios of totals (one row)."""
    money = ("cost", "revenue")
    t = creative_totals(ads, spend).agg(*[(F.round(F.sum(x), 4) if x in money else F.sum(x)).alias(x) for x in (
        "impressions", "cost", "clicks", "conversions", "revenue", "video_views", "video_completions")])
    return cost_metrics(t)


def lowest_cost(metrics: DataFrame, metric: str = "cpa", k: int = 10, key: str = "CREATIVE_ID") -> DataFrame:
    """Top-k by *lowest* cost metric (the documented meaning of "top")."""
    return metrics.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).asc(), F.col(key).asc()).limit(k)


def segment_efficiency(ads: DataFrame, ind: DataFrame, spend: DataFrame, segment: str = "AGE_BUCKET") -> DataFrame:
    """Creative cost / devices of a segment the creative reached."""
    seg_reach = ads.select("CREATIVE_ID", "AKKIO_ID").join(ind.select("AKKIO_ID", segment), "AKKIO_ID", "inner") \
        .groupBy("CREATIVE_ID", segment).agg(F.countDistinct("AKKIO_ID").alias("segment_reach"))
    cost = spend.groupBy(F.col("value").alias("CREATIVE_ID")).agg(F.round(F.sum("cost"), 4).alias("cost"))
    j = seg_reach.join(cost, "CREATIVE_ID", "left")
    return j.withColumn("cost_per_reached", safe_metric(F.col("cost"), F.col("segment_reach")))


# ------------------------------------------------------------ market metrics
def market_penetration(campaign: DataFrame, with_ue: bool = False) -> DataFrame:
    aggs = [F.countDistinct("AKKIO_ID").alias("reach"), F.count(F.lit(1)).alias("impressions"),
            F.max("MARKET_TV_POPULATION").alias("tv_population")]
    if with_ue:
        aggs.append(F.max("MARKET_UE_POPULATION").alias("ue_population"))
    g = campaign.groupBy("MARKET").agg(*aggs)
    g = g.withColumn("penetration_pct", F.round(pct(F.col("reach"), F.col("tv_population")), 4))
    if with_ue:
        g = g.withColumn("ue_penetration_pct", F.round(pct(F.col("reach"), F.col("ue_population")), 4))
    return g


def grp(campaign: DataFrame) -> DataFrame:
    g = campaign.groupBy("MARKET").agg(F.count(F.lit(1)).alias("impressions"),
                                       F.max("MARKET_TV_POPULATION").alias("tv_population"))
    return g.withColumn("grp", F.round(pct(F.col("impressions"), F.col("tv_population")), 4))


def incremental_reach(campaign: DataFrame, detail: DataFrame) -> DataFrame:
    """Devices by (campaign exposed, other linear, other streaming) flags."""
    cls = text.source_class("INPUT_CATEGORY")
    flags = campaign.select("AKKIO_ID", F.lit(1).alias("c"), F.lit(0).alias("l"), F.lit(0).alias("s")).unionByName(
        detail.select("AKKIO_ID", F.lit(0).alias("c"), F.when(cls == "Linear", 1).otherwise(0).alias("l"),
                      F.when(cls == "Streaming", 1).otherwise(0).alias("s")))
    per_dev = flags.groupBy("AKKIO_ID").agg(F.max("c").alias("campaign"), F.max("l").alias("other_linear"),
                                            F.max("s").alias("other_streaming"))
    return per_dev.groupBy("campaign", "other_linear", "other_streaming").agg(F.count(F.lit(1)).alias("devices"))


QUARTER = 900          # seconds: within a quarter of an hour the local hour doesn't change, in any zone's present rules
TWO_DAYS = 2 * 24 * 4  # quarters: a session that lasts longer has touched every local hour by then, clock changes included


def daypart_viewing(detail: DataFrame) -> DataFrame:
    """Per local hour: sessions and devices that viewed in it, and the seconds viewed in it.

    A session counts in every local hour that it touches, with the seconds it has there, so the
    seconds of all hours add up to those of all sessions.  Seconds come from a sweep
    per time zone (``operators.sweep``), which doesn't cut sessions into rows.  Sessions
    and devices come from the distinct local hours that a session touches, 24 at most.
    Devices without a time zone are a row without hour.
    """
    quarters = seconds_per_bucket(detail, "SESSION_START_TIME_UTC", "TOTAL_SECONDS", ["TIMEZONE"], QUARTER)
    swept = quarters.select(F.hour(local_time(bucket_start(F.col("bucket"), QUARTER), "TIMEZONE")).alias("local_hour"), "seconds")
    touched = F.transform(buckets_touched("SESSION_START_TIME_UTC", "TOTAL_SECONDS", QUARTER, TWO_DAYS),
                          lambda k: F.hour(local_time(bucket_start(k, QUARTER), "TIMEZONE")))
    seen = detail.where(F.col("TOTAL_SECONDS") > 0).select("AKKIO_ID", F.explode(F.array_distinct(touched)).alias("local_hour"))
    seen = seen.groupBy("local_hour", "AKKIO_ID").agg(F.count(F.lit(1)).alias("sessions"))
    seen = seen.groupBy("local_hour").agg(F.sum("sessions").alias("sessions"), F.count("AKKIO_ID").alias("viewers"))
    zero = F.lit(0).cast("long")
    both = swept.groupBy("local_hour").agg(F.sum("seconds").alias("seconds")).select("local_hour", zero.alias("sessions"), "seconds", zero.alias("viewers"))
    both = both.unionByName(seen.select("local_hour", "sessions", zero.alias("seconds"), "viewers"))  # 25 rows of either
    return both.groupBy(daypart_of("local_hour").alias("daypart"), "local_hour").agg(*(F.sum(c).alias(c) for c in ("sessions", "seconds", "viewers")))


def concurrent_sessions(detail: DataFrame, by: tuple = ("DMA",)) -> DataFrame:
    """Per UTC hour: the most sessions under way at the start of one of its minutes, and session-minutes."""
    by = list(by)
    minutes = under_way(detail, "SESSION_START_TIME_UTC", "TOTAL_SECONDS", by, 60)
    hour = F.date_trunc("HOUR", bucket_start(F.col("bucket"), 60)).cast("timestamp_ntz")
    return minutes.groupBy(*by, hour.alias("hour_utc")).agg(F.max("rows").alias("peak_sessions"), F.sum("rows").alias("session_minutes"))


# ------------------------------------------------------------ sessions
def single_sessions(detail: DataFrame, threshold: int = CONSECUTIVE_THRESHOLD) -> DataFrame:
    return detail.filter(F.col("TOTAL_SECONDS") >= threshold)


def connected_sessions(sessions: DataFrame, keys=("hash", "date_partition", "show_title", "channel_affiliate"),
                       start: str = "ts_start", end: str = "ts_end", gap_seconds: int = CONNECT_GAP_SECONDS,
                       seconds: Column | None = None) -> DataFrame:
    """Islands of sessions of one title on one network, gap <= 5 min."""
    return island_summary(sessions, list(keys), start, end, gap_seconds, seconds)


def ad_breaks(ads: DataFrame, gap_seconds: int = AD_BREAK_GAP_SECONDS) -> DataFrame:
    """Ads of one device grouped into breaks (next ad starts <= gap after), across midnight too.

    Distinct brands per break are merged from per-piece brand sets (bounded
    by the brands in one break), so no extra pass over the rows is needed.
    """
    return island_summary(
        ads, ["AKKIO_ID"], "AD_MATCH_START_TIME_UTC", "AD_MATCH_END_TIME_UTC", gap_seconds,
        seconds=F.col("AD_LENGTH"),
        piece_aggs=[F.collect_set("BRAND_NAME").alias("__brands")],
        merge_aggs=[F.size(F.array_distinct(F.flatten(F.collect_list("__brands")))).cast("long").alias("brands")])


def ad_context(ads: DataFrame) -> DataFrame:
    return ads.groupBy("BRAND_NAME", "PREV_TITLE", "NEXT_TITLE").agg(
        F.count(F.lit(1)).alias("ad_views"), F.countDistinct("AKKIO_ID").alias("reach"))


def geo_distribution(standard: DataFrame) -> DataFrame:
    return standard.groupBy("STATE_CODE", "DMA", "CITY").agg(
        F.countDistinct("AKKIO_ID").alias("active_devices"), F.count(F.lit(1)).alias("device_days"),
        F.sum("TOTAL_SECONDS").alias("total_seconds"))


def available_range(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """min/max date and rows per table -- gate out-of-range requests."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.min(col).alias("min_date"), F.max(col).alias("max_date"),
                    F.count(F.lit(1)).alias("row_count"))
             for name, (df, col) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

