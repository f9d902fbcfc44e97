"""Real feeds: each named feed bound to a path, a format and its columns.

A binding is a JSON object ``feed -> {"path", "format" (parquet), "options",
"columns" {our column: their column}}``.  ``BoundSources`` reads the feeds
lazily with explicit schemas, casts to the types the models expect and offers
the same attributes as the test projections in ``fixtures.Sources``, so every
model runs on either.  ``assert_unique`` proves the keys that joins rely on.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewgrid.sources.fixtures import DEMO_COLUMNS

_SESSION = "date_partition date, hash string, zipcode string, dma string, ts_start timestamp, ts_end timestamp, live string, input_category string, input_device string, app_service string"
_IMPRESSION = (
    "hashed_tvid string, imp_ts timestamp, zipcode string, market string, show_title string, station_call_sign string, "
    "channel_affiliate string, local_or_national string, session_type string, session_source string"
)
_POPULATION = "market string, inscape_tv_population bigint, ue_population bigint"

#: Columns of every feed, as the models read them.
SCHEMAS = {
    "content": _SESSION + ", channel_affiliate string, channel_callsign string, episode_id string, show_title string, air_date date",
    "commercial": _SESSION + ", ip string, value string, duration double, brand_name string, title string, prev_episode_id string, prev_title string, "
    "prev_ts_start timestamp, prev_ts_end timestamp, prev_channel_callsign string, prev_network_affiliate string, next_episode_id string, "
    "next_title string, next_ts_start timestamp, next_ts_end timestamp, next_channel_callsign string, next_network_affiliate string",
    "device": "date_partition date, hash string, ts_start timestamp, ts_end timestamp, city string, iso_state string, dma string, zipcode int",
    "genre_map": "episode_id string, genre string",
    "tz_map": "hash string, timezone string",
    "category_map": "value string, commercial_category string",
    "demographics": "hash string, " + ", ".join(f"{c} int" for c in DEMO_COLUMNS),
    "impressions": _IMPRESSION,
    "population": _POPULATION,
    "impressions_fbfs": _IMPRESSION,
    "population_fbfs": _POPULATION,
    "optout": "hash string, optout_date date",
    "first_party": "client_record_id string, email string, phone string, zip string, ip string, segment_hint string, lifetime_value double, known_tv_id string, maid string",
    "registrations": "tv_id string, email string, phone string, maid string",
    "ad_spend": "value string, spend_date date, cost double, clicks bigint, conversions int, revenue double, video_views bigint, video_completions bigint",
}

#: Feeds that no model reads: audience work, opt-outs and cost metrics fail without them when they are asked for.
OPTIONAL = {"optout", "first_party", "registrations", "ad_spend"}

#: Key of every feed that is joined as a mapping: a repeated key would multiply fact rows.
UNIQUE_KEYS = {
    "genre_map": ["episode_id"], "tz_map": ["hash"], "category_map": ["value"], "demographics": ["hash"],
    "population": ["market"], "population_fbfs": ["market"],
}


def assert_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df``, or an error that names how many key values repeat."""
    n = df.groupBy(*keys).count().where("count > 1").count()
    if n:
        raise ValueError(f"{name}: {n} values of {', '.join(keys)} occur more than once")
    return df


class BoundSources:
    """Feeds read from their own places; attribute names are those of ``SCHEMAS``."""

    def __init__(self, spark: SparkSession, binding: dict[str, dict], check_keys: bool = True):
        missing, unknown = set(SCHEMAS) - OPTIONAL - set(binding), set(binding) - set(SCHEMAS)
        if missing or unknown:
            raise ValueError(f"feeds not bound: {sorted(missing)}; unknown feeds: {sorted(unknown)}")
        self.spark, self.binding, self.check_keys = spark, binding, check_keys
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, check_keys: bool = True) -> BoundSources:
        """Binding read from a JSON file through Spark, so it may lie in any store."""
        text = spark.read.text(path, wholetext=True).first()[0]
        return cls(spark, json.loads(text), check_keys)

    def _read(self, name: str) -> DataFrame:
        b = self.binding[name]
        names = b.get("columns", {})
        raw = self.spark.read.format(b.get("format", "parquet")).options(**b.get("options", {})).load(b["path"])
        fields = [x.rsplit(" ", 1) for x in SCHEMAS[name].split(", ")]
        absent = [names.get(c, c) for c, _ in fields if names.get(c, c) not in raw.columns]
        if absent:
            raise ValueError(f"{name}: columns {absent} are not in {b['path']}")
        df = raw.select(*(F.col(f"`{names.get(c, c)}`").cast(t).alias(c) for c, t in fields))
        return assert_unique(df, UNIQUE_KEYS[name], name) if self.check_keys and name in UNIQUE_KEYS else df

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self.binding:
            raise ValueError(f"feed not bound: {name}")
        if name not in self._cache:
            self._cache[name] = self._read(name)
        return self._cache[name]
