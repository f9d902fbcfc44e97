"""Registry: documented analytics with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewgrid.functions import text
from viewgrid.operators import sketches
from viewgrid.plans import analytics as A
from viewgrid.registry.base import cte, project, register, written
from viewgrid.session import scratch_path
from viewgrid.sinks import writers
from viewgrid.sources.fixtures import Sources


def _pct(a: str, b: str) -> str:
    return f"100 * (CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def _metric(a: str, b: str) -> str:
    return f"nullif(round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 2), 0)"


# ------------------------------------------------------------ cross-table
def _of_day(table: str, column: str) -> str:
    """Value of the impression's device-day in a daily table."""
    return f"(SELECT any_value(d.{column}) FROM {table} d WHERE d.AKKIO_ID = i.AKKIO_ID AND d.PARTITION_DATE = i.PARTITION_DATE)"


@register("q_campaign_content", f"""
SELECT AKKIO_ID, PARTITION_DATE, IMPRESSION_TIMESTAMP, SHOW_TITLE AS impression_context,
  {_of_day('content_summary', 'GENRE_STR_LIST')} AS daily_genres_watched,
  {_of_day('content_summary', 'TOTAL_VIEWING_SECONDS')} AS TOTAL_VIEWING_SECONDS
FROM campaign_nbc i""", ("campaign_nbc", "content_summary"))
def q_campaign_content(spark, sf):
    p = project(spark, sf)
    return A.campaign_content(p.ref("campaign_nbc"), p.ref("content_summary"))


@register("q_campaign_demo_reach", """
WITH per_device AS (SELECT MARKET, AKKIO_ID, count(*) AS shown FROM campaign_fbfs GROUP BY 1, 2),
known AS (SELECT d.*, (SELECT any_value(AGE_BUCKET) FROM attributes_latest x WHERE x.AKKIO_ID = d.AKKIO_ID) AS AGE_BUCKET,
    (SELECT any_value(HOUSEHOLD_INCOME_K) FROM attributes_latest x WHERE x.AKKIO_ID = d.AKKIO_ID) AS HOUSEHOLD_INCOME_K FROM per_device d)
SELECT MARKET, AGE_BUCKET, HOUSEHOLD_INCOME_K, count(*) AS unique_reach, CAST(sum(shown) AS BIGINT) AS total_impressions
FROM known GROUP BY MARKET, AGE_BUCKET, HOUSEHOLD_INCOME_K""", ("campaign_fbfs", "attributes_latest"))
def q_campaign_demo_reach(spark, sf):
    p = project(spark, sf)
    return A.campaign_demo_reach(p.ref("campaign_fbfs"), p.ref("attributes_latest"))


@register("q_campaign_coviewing", f"""
SELECT AKKIO_ID, PARTITION_DATE, IMPRESSION_TIMESTAMP, {_of_day('commercial_summary', 'BRAND_NAME_STR_LIST')} AS other_brands_seen,
  {_of_day('commercial_summary', 'TOTAL_AD_VIEWS')} AS daily_ad_exposure
FROM campaign_nbc i""", ("campaign_nbc", "commercial_summary"))
def q_campaign_coviewing(spark, sf):
    p = project(spark, sf)
    return A.campaign_coviewing(p.ref("campaign_nbc"), p.ref("commercial_summary"))


@register("q_sports_high_value", """
WITH rich AS (FROM attributes_latest SELECT AKKIO_ID, AGE, GENDER, HOUSEHOLD_INCOME_K, EDUCATION_LEVEL WHERE HOUSEHOLD_INCOME_K > 99),
sport AS (FROM content_summary SELECT AKKIO_ID, PARTITION_DATE, TOTAL_VIEWING_SECONDS / 3600 AS total_hours WHERE contains(GENRE_STR_LIST, 'sports'))
SELECT * FROM rich NATURAL JOIN sport""", ("attributes_latest", "content_summary"))
def q_sports_high_value(spark, sf):
    p = project(spark, sf)
    return A.sports_high_value(p.ref("attributes_latest"), p.ref("content_summary"))


@register("q_household_viewing", """
WITH viewing AS (SELECT AKKIO_ID, sum(TOTAL_VIEWING_SECONDS) AS secs, count(*) AS days FROM content_summary GROUP BY 1)
SELECT STATE, DMA_NAME, INCOME_BUCKET, HOME_OWNERSHIP, count(DISTINCT AKKIO_HH_ID) AS household_count,
  round(CAST(sum(secs) AS DOUBLE) / sum(days) / 3600, 6) AS avg_viewing_hours
FROM viewing NATURAL JOIN attributes_latest
GROUP BY STATE, DMA_NAME, INCOME_BUCKET, HOME_OWNERSHIP""", ("attributes_latest", "content_summary"))
def q_household_viewing(spark, sf):
    p = project(spark, sf)
    return A.household_viewing(p.ref("attributes_latest"), p.ref("content_summary"))


@register("q_individual_audience", """
SELECT AKKIO_ID, GENDER, AGE, ETHNICITY_PREDICTION, INCOME, WEIGHT FROM agg_ind
WHERE AGE BETWEEN 25 AND 54 AND INCOME >= 75000 AND GENDER IN ('M', 'F')""", ("agg_ind",))
def q_individual_audience(spark, sf):
    return A.individual_audience(project(spark, sf).ref("agg_ind"))


@register("q_genre_by_demo", """
SELECT m.category AS genre, i.AGE_BUCKET, i.GENDER, CAST(sum(m.sessions) AS BIGINT) AS sessions,
  count(DISTINCT m.AKKIO_ID) AS viewers
FROM media_entries m JOIN agg_ind i ON m.AKKIO_ID = i.AKKIO_ID WHERE m.category_type = 'GENRES_WATCHED' GROUP BY ALL""",
          ("media_entries", "agg_ind"))
def q_genre_by_demo(spark, sf):
    p = project(spark, sf)
    return A.genre_by_demo(p.ref("agg_media"), p.ref("agg_ind"))


@register("q_seconds_by_income", """
SELECT i.INCOME_BUCKET, CAST(sum(cs.TOTAL_VIEWING_SECONDS) AS BIGINT) AS total_seconds,
  count(DISTINCT cs.AKKIO_ID) AS viewers, round(avg(cs.TOTAL_VIEWING_SECONDS), 4) AS avg_daily_seconds
FROM content_summary cs JOIN agg_ind i ON cs.AKKIO_ID = i.AKKIO_ID GROUP BY ALL""", ("content_summary", "agg_ind"))
def q_seconds_by_income(spark, sf):
    p = project(spark, sf)
    return A.seconds_by_income(p.ref("content_summary"), p.ref("agg_ind"))


@register("q_network_by_education", """
SELECT m.category AS network, i.EDUCATION, CAST(sum(m.sessions) AS BIGINT) AS sessions,
  count(DISTINCT m.AKKIO_ID) AS viewers
FROM media_entries m JOIN agg_ind i ON m.AKKIO_ID = i.AKKIO_ID WHERE m.category_type = 'NETWORKS_WATCHED' GROUP BY ALL""",
          ("media_entries", "agg_ind"))
def q_network_by_education(spark, sf):
    p = project(spark, sf)
    return A.network_by_education(p.ref("agg_media"), p.ref("agg_ind"))


# ------------------------------------------------------------ reach & frequency
@register("m_reach", "SELECT TITLE, count(DISTINCT AKKIO_ID) AS reach, count(*) AS views FROM content_detail GROUP BY TITLE",
          ("content_detail",))
def m_reach(spark, sf):
    return A.reach(project(spark, sf).ref("content_detail"), ["TITLE"])


@register("m_reach_brand",
          "SELECT BRAND_NAME, count(DISTINCT AKKIO_ID) AS reach, count(*) AS views FROM commercial_detail GROUP BY BRAND_NAME",
          ("commercial_detail",))
def m_reach_brand(spark, sf):
    return A.reach(project(spark, sf).ref("commercial_detail"), ["BRAND_NAME"])


ROLLING_DAYS = 7


@register("m_approx_reach", f"""
SELECT BRAND_NAME, window_end AS WINDOW_END, count(DISTINCT AKKIO_ID) AS reach, true AS within_bound
FROM (SELECT BRAND_NAME, AKKIO_ID, CAST(PARTITION_DATE + CAST(k AS INTEGER) AS DATE) AS window_end FROM commercial_detail, range({ROLLING_DAYS}) r(k))
WHERE window_end <= (SELECT max(PARTITION_DATE) FROM commercial_detail) GROUP BY ALL""", ("commercial_detail",))
def m_approx_reach(spark, sf):
    """Reach per brand over every window of seven days, from stored daily sketches; the exact
    count stands beside the verdict on the estimate, which is approximate and not returned."""
    detail = written(spark, sf, "commercial_detail").ref("commercial_detail")
    by = ["BRAND_NAME"]
    path = scratch_path(spark, "reach-by-brand")
    writers.write_model(sketches.daily_reach(detail, by), path, "reach_by_brand")
    estimates = sketches.rolling_reach(spark.read.parquet(path), by, ROLLING_DAYS)
    exact = A.reach(sketches.rolling_days(detail.select("PARTITION_DATE", "BRAND_NAME", "AKKIO_ID"), ROLLING_DAYS), [*by, "WINDOW_END"])
    return A.sketch_check(estimates, exact, [*by, "WINDOW_END"], "approx_reach", "reach", sketches.ERROR_BOUND * F.col("reach"))


_EXPOSURES = "(SELECT BRAND_NAME, AKKIO_ID, count(*) AS exposures FROM commercial_detail GROUP BY ALL)"


@register("m_avg_frequency", f"""
SELECT BRAND_NAME, CAST(sum(exposures) AS BIGINT) AS impressions, count(*) AS reach,
  round(CAST(sum(exposures) AS DOUBLE) / count(*), 4) AS avg_frequency FROM {_EXPOSURES} GROUP BY BRAND_NAME""",
          ("commercial_detail",))
def m_avg_frequency(spark, sf):
    return A.avg_frequency(project(spark, sf).ref("commercial_detail"))


@register("m_effective_reach", f"""
SELECT BRAND_NAME, count(*) AS reach, count(*) FILTER (WHERE exposures >= 3) AS effective_reach,
  round({_pct("count(*) FILTER (WHERE exposures >= 3)", "count(*)")}, 2) AS effective_reach_pct
FROM {_EXPOSURES} GROUP BY BRAND_NAME""", ("commercial_detail",))
def m_effective_reach(spark, sf):
    return A.effective_reach(project(spark, sf).ref("commercial_detail"))


@register("m_frequency_distribution", f"""
SELECT BRAND_NAME, exposures, count(*) AS devices FROM {_EXPOSURES} GROUP BY ALL""", ("commercial_detail",))
def m_frequency_distribution(spark, sf):
    return A.frequency_distribution(project(spark, sf).ref("commercial_detail"))


@register("m_sov", f"""
SELECT PARTITION_DATE, BRAND_NAME, count(*) AS impressions,
  round({_pct("count(*)", "sum(count(*)) OVER (PARTITION BY PARTITION_DATE)")}, 4) AS sov_pct
FROM commercial_detail GROUP BY PARTITION_DATE, BRAND_NAME""", ("commercial_detail",))
def m_sov(spark, sf):
    return A.share_of_voice(project(spark, sf).ref("commercial_detail"))


@register("m_live_share", f"""
SELECT NETWORK, count(*) AS sessions, count(*) FILTER (WHERE WATCHED_LIVE = 't') AS live_sessions,
  CAST(sum(TOTAL_SECONDS) AS BIGINT) AS seconds,
  CAST(sum(CASE WHEN WATCHED_LIVE = 't' THEN TOTAL_SECONDS ELSE 0 END) AS BIGINT) AS live_seconds,
  round({_pct("count(*) FILTER (WHERE WATCHED_LIVE = 't')", "count(*)")}, 1) AS live_pct,
  round(100 - round({_pct("count(*) FILTER (WHERE WATCHED_LIVE = 't')", "count(*)")}, 1), 1) AS time_shifted_pct
FROM content_detail GROUP BY NETWORK""", ("content_detail",))
def m_live_share(spark, sf):
    return A.live_share(project(spark, sf).ref("content_detail"))


cte("transitions", """
SELECT *, coalesce(next_TITLE IS NOT NULL AND next_TITLE <> TITLE
                   AND date_sub('second', SESSION_END_TIME_UTC, next_start) <= 300, false) AS continued
FROM (SELECT *, lead(TITLE) OVER w AS next_TITLE, lead(SESSION_START_TIME_UTC) OVER w AS next_start
      FROM content_detail
      WINDOW w AS (PARTITION BY AKKIO_ID
                   ORDER BY SESSION_START_TIME_UTC NULLS FIRST, SESSION_END_TIME_UTC NULLS FIRST, TITLE NULLS FIRST))""",
    "content_detail")


@register("m_retention", f"""
SELECT TITLE, count(DISTINCT AKKIO_ID) AS viewers,
  count(DISTINCT CASE WHEN continued THEN AKKIO_ID END) AS retained_viewers,
  round({_pct("count(DISTINCT CASE WHEN continued THEN AKKIO_ID END)", "count(DISTINCT AKKIO_ID)")}, 2) AS retention_pct
FROM transitions GROUP BY TITLE""", ("transitions",))
def m_retention(spark, sf):
    return A.retention(written(spark, sf, "content_detail").ref("content_detail"))


@register("m_lead_in", """
SELECT TITLE AS lead_in_title, next_TITLE AS following_title, count(DISTINCT AKKIO_ID) AS lead_in_viewers,
  count(*) AS transitions FROM transitions WHERE continued GROUP BY ALL""", ("transitions",))
def m_lead_in(spark, sf):
    return A.lead_in(written(spark, sf, "content_detail").ref("content_detail"))


@register("m_cross_network", f"""
WITH dn AS (SELECT DISTINCT AKKIO_ID, NETWORK FROM content_detail WHERE NETWORK IS NOT NULL),
pd AS (SELECT AKKIO_ID, count(*) AS n FROM dn GROUP BY AKKIO_ID)
SELECT NETWORK, count(*) AS viewers, count(*) FILTER (WHERE n = 1) AS exclusive_viewers,
  count(*) FILTER (WHERE n >= 2) AS cross_viewers,
  round({_pct("count(*) FILTER (WHERE n >= 2)", "count(*)")}, 2) AS cross_pct
FROM dn JOIN pd ON dn.AKKIO_ID = pd.AKKIO_ID GROUP BY NETWORK""", ("content_detail",))
def m_cross_network(spark, sf):
    return A.cross_network(project(spark, sf).ref("content_detail"))


@register("m_segment_affinity", """
WITH seg AS (SELECT AKKIO_ID, AGE_BUCKET FROM agg_ind),
active AS (SELECT DISTINCT AKKIO_ID FROM content_detail),
seg_size AS (SELECT AGE_BUCKET, count(*) AS segment_devices FROM seg JOIN active ON seg.AKKIO_ID = active.AKKIO_ID GROUP BY 1),
alld AS (SELECT sum(segment_devices) AS all_devices FROM seg_size),
v AS (SELECT d.NETWORK, seg.AGE_BUCKET, count(*) AS segment_viewers
      FROM (SELECT DISTINCT AKKIO_ID, NETWORK FROM content_detail) d JOIN seg ON d.AKKIO_ID = seg.AKKIO_ID GROUP BY ALL)
SELECT v.NETWORK, v.AGE_BUCKET, v.segment_viewers, s.segment_devices,
  round(100 * ((CAST(v.segment_viewers AS DOUBLE) / s.segment_devices)
    / (CAST(sum(v.segment_viewers) OVER (PARTITION BY v.NETWORK) AS DOUBLE) / alld.all_devices)), 2) AS affinity_index
FROM v JOIN seg_size s ON v.AGE_BUCKET = s.AGE_BUCKET CROSS JOIN alld""", ("agg_ind", "content_detail"))
def m_segment_affinity(spark, sf):
    p = project(spark, sf)
    return A.segment_affinity(p.ref("content_detail"), p.ref("agg_ind"))


_SPEND_TOTALS = """
sp AS (SELECT value AS CREATIVE_ID, round(sum(cost), 4) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
         CAST(sum(conversions) AS BIGINT) AS conversions, round(sum(revenue), 4) AS revenue,
         CAST(sum(video_views) AS BIGINT) AS video_views, CAST(sum(video_completions) AS BIGINT) AS video_completions
       FROM fx_ad_spend GROUP BY 1)"""

cte("creative_totals", f"""
WITH imp AS (SELECT CREATIVE_ID, count(*) AS impressions, count(DISTINCT AKKIO_ID) AS reach FROM commercial_detail GROUP BY 1),
{_SPEND_TOTALS}
SELECT coalesce(imp.CREATIVE_ID, sp.CREATIVE_ID) AS CREATIVE_ID, impressions, reach, cost, clicks, conversions, revenue,
  video_views, video_completions
FROM imp FULL JOIN sp ON imp.CREATIVE_ID = sp.CREATIVE_ID""", "commercial_detail", "fx_ad_spend")

_METRICS = ", ".join([
    f"{_metric('cost', 'clicks')} AS cpc", f"{_metric('cost * 1000', 'impressions')} AS cpm",
    f"{_metric('cost', 'impressions * 1000')} AS cpm_documented", f"{_metric('conversions', 'clicks')} AS cvr",
    f"{_metric('clicks', 'impressions')} AS ctr", f"{_metric('cost', 'conversions')} AS cpa",
    f"{_metric('cost', 'video_views')} AS cpv", f"{_metric('cost', 'video_completions')} AS cpcv",
    f"{_metric('video_completions', 'video_views')} AS vtr", f"{_metric('revenue', 'cost')} AS roas"])

cte("cost_metrics", f"SELECT *, {_METRICS} FROM creative_totals", "creative_totals")


@register("m_ad_cost_metrics", "SELECT * FROM cost_metrics", ("cost_metrics",))
def m_ad_cost_metrics(spark, sf):
    p = project(spark, sf)
    return A.ad_cost_metrics(p.ref("commercial_detail"), p.src.ad_spend)


@register("m_ad_cost_totals", f"""
SELECT *, {_METRICS} FROM (
  SELECT CAST(sum(impressions) AS BIGINT) AS impressions, round(sum(cost), 4) AS cost, CAST(sum(clicks) AS BIGINT) AS clicks,
    CAST(sum(conversions) AS BIGINT) AS conversions, round(sum(revenue), 4) AS revenue,
    CAST(sum(video_views) AS BIGINT) AS video_views, CAST(sum(video_completions) AS BIGINT) AS video_completions
  FROM creative_totals)""", ("creative_totals",))
def m_ad_cost_totals(spark, sf):
    p = project(spark, sf)
    return A.ad_cost_totals(p.ref("commercial_detail"), p.src.ad_spend)


@register("topk_lowest_cost", "SELECT * FROM cost_metrics WHERE cpa IS NOT NULL ORDER BY cpa, CREATIVE_ID LIMIT 10",
          ("cost_metrics",))
def topk_lowest_cost(spark, sf):
    """Top 10 creatives by lowest cost per acquisition (the limit is the feature)."""
    p = project(spark, sf)
    return A.lowest_cost(A.ad_cost_metrics(p.ref("commercial_detail"), p.src.ad_spend), "cpa", 10)


@register("m_segment_efficiency", f"""
WITH sr AS (SELECT c.CREATIVE_ID, i.AGE_BUCKET, count(DISTINCT c.AKKIO_ID) AS segment_reach
            FROM commercial_detail c JOIN agg_ind i ON c.AKKIO_ID = i.AKKIO_ID GROUP BY ALL),
cost AS (SELECT value AS CREATIVE_ID, round(sum(cost), 4) AS cost FROM fx_ad_spend GROUP BY 1)
SELECT sr.CREATIVE_ID, sr.AGE_BUCKET, sr.segment_reach, cost.cost, {_metric('cost.cost', 'sr.segment_reach')} AS cost_per_reached
FROM sr LEFT JOIN cost ON sr.CREATIVE_ID = cost.CREATIVE_ID""", ("commercial_detail", "agg_ind", "fx_ad_spend"))
def m_segment_efficiency(spark, sf):
    p = project(spark, sf)
    return A.segment_efficiency(p.ref("commercial_detail"), p.ref("agg_ind"), p.src.ad_spend)


# ------------------------------------------------------------ market metrics
@register("m_market_penetration", f"""
SELECT MARKET, count(DISTINCT AKKIO_ID) AS reach, count(*) AS impressions, max(MARKET_TV_POPULATION) AS tv_population,
  max(MARKET_UE_POPULATION) AS ue_population,
  round({_pct("count(DISTINCT AKKIO_ID)", "max(MARKET_TV_POPULATION)")}, 4) AS penetration_pct,
  round({_pct("count(DISTINCT AKKIO_ID)", "max(MARKET_UE_POPULATION)")}, 4) AS ue_penetration_pct
FROM campaign_fbfs GROUP BY MARKET""", ("campaign_fbfs",))
def m_market_penetration(spark, sf):
    return A.market_penetration(project(spark, sf).ref("campaign_fbfs"), with_ue=True)


@register("m_grp", f"""
SELECT MARKET, count(*) AS impressions, max(MARKET_TV_POPULATION) AS tv_population,
  round({_pct("count(*)", "max(MARKET_TV_POPULATION)")}, 4) AS grp FROM campaign_nbc GROUP BY MARKET""", ("campaign_nbc",))
def m_grp(spark, sf):
    return A.grp(project(spark, sf).ref("campaign_nbc"))


_CLASS = ("CASE WHEN replace(upper({c}), '-', ' ') IN ('HD TV', 'SD TV') THEN 'Linear' "
          "WHEN {c} IS NOT NULL THEN 'Streaming' END")


@register("m_incremental_reach", f"""
SELECT campaign, other_linear, other_streaming, count(*) AS devices FROM (
  SELECT AKKIO_ID, max(c) AS campaign, max(l) AS other_linear, max(s) AS other_streaming FROM (
    SELECT AKKIO_ID, 1 AS c, 0 AS l, 0 AS s FROM campaign_nbc
    UNION ALL
    SELECT AKKIO_ID, 0, CASE WHEN cls = 'Linear' THEN 1 ELSE 0 END, CASE WHEN cls = 'Streaming' THEN 1 ELSE 0 END
    FROM (SELECT AKKIO_ID, {_CLASS.format(c='INPUT_CATEGORY')} AS cls FROM content_detail)) GROUP BY AKKIO_ID)
GROUP BY ALL""", ("campaign_nbc", "content_detail"))
def m_incremental_reach(spark, sf):
    p = project(spark, sf)
    return A.incremental_reach(p.ref("campaign_nbc"), p.ref("content_detail"))


AUDIENCES = ["campaign", "other_linear", "other_streaming"]


@register("m_incremental_reach_sketch", f"""
SELECT campaign, other_linear, other_streaming, count(*) AS devices, true AS within_bound FROM (
  SELECT AKKIO_ID, max(c) AS campaign, max(l) AS other_linear, max(s) AS other_streaming FROM (
    SELECT AKKIO_ID, 1 AS c, 0 AS l, 0 AS s FROM campaign_nbc
    UNION ALL
    SELECT AKKIO_ID, 0, CASE WHEN cls = 'Linear' THEN 1 ELSE 0 END, CASE WHEN cls = 'Streaming' THEN 1 ELSE 0 END
    FROM (SELECT AKKIO_ID, {_CLASS.format(c='INPUT_CATEGORY')} AS cls FROM content_detail)) GROUP BY AKKIO_ID)
GROUP BY ALL""", ("campaign_nbc", "content_detail"))
def m_incremental_reach_sketch(spark, sf):
    """The overlaps of m_incremental_reach from stored daily theta sketches, beside the exact counts."""
    p = written(spark, sf, "campaign_nbc", "content_detail")
    campaign, detail = p.ref("campaign_nbc"), p.ref("content_detail")
    source = text.source_class("INPUT_CATEGORY")
    parts = {"campaign": campaign, "other_linear": detail.where(source == "Linear"), "other_streaming": detail.where(source == "Streaming"), "every": detail}
    path = scratch_path(spark, "audience-sketches")
    sketches.daily_audiences(parts).write.partitionBy("PARTITION_DATE").parquet(path)
    cells = sketches.audience_cells(spark.read.parquet(path), AUDIENCES, "every")
    exact = A.incremental_reach(campaign, detail)
    devices = exact.agg(F.sum("devices").alias("all_devices")).first()[0] or 0  # the error of a cell is relative to the union
    checked = A.sketch_check(cells, exact, AUDIENCES, "approx_devices", "devices", F.lit(sketches.ERROR_BOUND * devices))
    return checked.where("devices is not null")  # the sketches have all eight cells, empty ones too


@register("m_daypart", """
WITH s AS (SELECT row_number() OVER () AS id, AKKIO_ID, TIMEZONE, CAST(floor(epoch(SESSION_START_TIME_UTC)) AS BIGINT) AS a, TOTAL_SECONDS AS n FROM content_detail),
m AS (SELECT id, AKKIO_ID, TIMEZONE, a, a + n AS b, unnest(range(a // 60, (a + n - 1) // 60 + 1)) AS minute FROM s WHERE n > 0),
h AS (SELECT id, AKKIO_ID, CAST(hour(CAST((make_timestamp(minute * 60000000) AT TIME ZONE 'UTC') AT TIME ZONE TIMEZONE AS TIMESTAMP)) AS INTEGER) AS local_hour,
        least(b, (minute + 1) * 60) - greatest(a, minute * 60) AS secs FROM m)
SELECT CASE WHEN local_hour BETWEEN 20 AND 22 THEN 'prime' WHEN local_hour BETWEEN 9 AND 16 THEN 'daytime' WHEN local_hour IS NOT NULL THEN 'other' END AS daypart,
  local_hour, count(DISTINCT id) AS sessions, CAST(sum(secs) AS BIGINT) AS seconds, count(DISTINCT AKKIO_ID) AS viewers
FROM h GROUP BY ALL""", ("content_detail",))
def m_daypart(spark, sf):
    return A.daypart_viewing(written(spark, sf, "content_detail").ref("content_detail"))


@register("m_concurrent_sessions", """
WITH s AS (SELECT DMA, CAST(floor(epoch(SESSION_START_TIME_UTC)) AS BIGINT) AS a, TOTAL_SECONDS AS n FROM content_detail),
m AS (SELECT DMA, unnest(range((a + 59) // 60, (a + n + 59) // 60)) AS minute FROM s WHERE n > 0),
c AS (SELECT DMA, minute, count(*) AS under_way FROM m GROUP BY ALL)
SELECT DMA, make_timestamp(minute // 60 * 3600000000) AS hour_utc, max(under_way) AS peak_sessions, CAST(sum(under_way) AS BIGINT) AS session_minutes
FROM c GROUP BY ALL""", ("content_detail",))
def m_concurrent_sessions(spark, sf):
    return A.concurrent_sessions(project(spark, sf).ref("content_detail"))


@register("c_source_class", f"""
SELECT AKKIO_ID, SESSION_START_TIME_UTC, INPUT_CATEGORY, {_CLASS.format(c='INPUT_CATEGORY')} AS SOURCE_CLASS
FROM content_detail""", ("content_detail",))
def c_source_class(spark, sf):
    d = project(spark, sf).ref("content_detail")
    return d.select("AKKIO_ID", "SESSION_START_TIME_UTC", "INPUT_CATEGORY",
                    text.source_class("INPUT_CATEGORY").alias("SOURCE_CLASS"))


@register("c_source_class_ads", f"""
SELECT AKKIO_ID, AD_MATCH_START_TIME_UTC, INPUT_CATEGORY, {_CLASS.format(c='INPUT_CATEGORY')} AS SOURCE_CLASS
FROM commercial_detail""", ("commercial_detail",))
def c_source_class_ads(spark, sf):
    d = project(spark, sf).ref("commercial_detail")
    return d.select("AKKIO_ID", "AD_MATCH_START_TIME_UTC", "INPUT_CATEGORY",
                    text.source_class("INPUT_CATEGORY").alias("SOURCE_CLASS"))


# ------------------------------------------------------------ sessions
@register("s_single_session", "SELECT * FROM content_detail WHERE TOTAL_SECONDS >= 300", ("content_detail",))
def s_single_session(spark, sf):
    return A.single_sessions(project(spark, sf).ref("content_detail"))


def _islands_sql(src: str, keys: list[str], start: str, end: str, gap: int, secs: str, extra: str = "") -> str:
    k = ", ".join(keys)
    w = f"PARTITION BY {k} ORDER BY {start}, {end}"
    return f"""
SELECT {k}, CAST(island_no AS BIGINT) AS island_no, min({start}) AS island_start, max({end}) AS island_end,
  count(*) AS sessions, CAST(sum({secs}) AS BIGINT) AS total_seconds{extra}
FROM (SELECT *, sum(new_island) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island_no
      FROM (SELECT *, CASE WHEN prev_end IS NULL OR {start} > prev_end + INTERVAL {gap} SECOND THEN 1 ELSE 0 END AS new_island
            FROM (SELECT *, max({end}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM {src})))
GROUP BY ALL"""


_DENSE_KEYS = ["hash", "date_partition", "show_title", "channel_affiliate"]
cte("connected_islands", _islands_sql("fx_dense", _DENSE_KEYS, "ts_start", "ts_end", 300,
                                      "date_sub('second', ts_start, ts_end)"), "fx_dense")


@register("win_connected_sessions", "SELECT * FROM connected_islands", ("connected_islands",))
def win_connected_sessions(spark, sf):
    """All islands (gap <= 5 min) of the dense session fixture."""
    return A.connected_sessions(Sources(spark, sf)["fx_dense"])


@register("s_connected_sessions", "SELECT * FROM connected_islands WHERE total_seconds >= 300", ("connected_islands",))
def s_connected_sessions(spark, sf):
    """Connected sessions reaching the 5-minute threshold."""
    isl = A.connected_sessions(Sources(spark, sf)["fx_dense"])
    return isl.filter(F.col("total_seconds") >= A.CONSECUTIVE_THRESHOLD)


@register("s_ad_break", _islands_sql("commercial_detail", ["AKKIO_ID"], "AD_MATCH_START_TIME_UTC",
                                     "AD_MATCH_END_TIME_UTC", 60, "AD_LENGTH", ", count(DISTINCT BRAND_NAME) AS brands"),
          ("commercial_detail",))
def s_ad_break(spark, sf):
    return A.ad_breaks(written(spark, sf, "commercial_detail").ref("commercial_detail"))


@register("q_ad_context", """
SELECT BRAND_NAME, PREV_TITLE, NEXT_TITLE, count(*) AS ad_views, count(DISTINCT AKKIO_ID) AS reach
FROM commercial_detail GROUP BY ALL""", ("commercial_detail",))
def q_ad_context(spark, sf):
    return A.ad_context(project(spark, sf).ref("commercial_detail"))


@register("q_geo_distribution", """
SELECT STATE_CODE, DMA, CITY, count(DISTINCT AKKIO_ID) AS active_devices, count(*) AS device_days,
  CAST(sum(TOTAL_SECONDS) AS BIGINT) AS total_seconds FROM standard_detail GROUP BY ALL""", ("standard_detail",))
def q_geo_distribution(spark, sf):
    return A.geo_distribution(project(spark, sf).ref("standard_detail"))


_RANGE_TABLES = [("content_detail", "PARTITION_DATE"), ("commercial_detail", "PARTITION_DATE"),
                 ("standard_detail", "PARTITION_DATE"), ("campaign_nbc", "IMPRESSION_DATE"),
                 ("campaign_fbfs", "IMPRESSION_DATE"), ("attributes_latest", "PARTITION_DATE")]


@register("g_available_range", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, min({c}) AS min_date, max({c}) AS max_date, count(*) AS row_count FROM {t}"
    for t, c in _RANGE_TABLES), tuple(t for t, _ in _RANGE_TABLES))
def g_available_range(spark, sf):
    p = project(spark, sf)
    return A.available_range({t: (p.ref(t), c) for t, c in _RANGE_TABLES})
