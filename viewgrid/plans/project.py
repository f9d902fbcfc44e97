"""A build of all models over one set of sources, with ``ref`` by name.

``Project(spark, sf_dir).ref("content_summary")`` returns the model's
DataFrame, building its upstream models (memoised) the way ``ref()`` resolves
a model's dependencies.  ``build_all`` writes every model in dependency order
and re-reads the written tables, so downstream models start from files rather
than re-deriving upstream lineage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from viewgrid.operators import sketches
from viewgrid.operators.incremental import Window, apply_window
from viewgrid.plans import models
from viewgrid.sources.fixtures import Sources

# model -> upstream models, in a valid build order
MODEL_DEPS = {
    "content_detail": (),
    "commercial_detail": (),
    "standard_detail": (),
    "attributes_latest": (),
    "content_summary": ("content_detail",),
    "commercial_summary": ("commercial_detail",),
    "standard_summary": ("standard_detail",),
    "agg_media": ("content_detail",),
    "agg_hh": ("attributes_latest",),
    "agg_ind": ("attributes_latest",),
    "campaign_nbc": ("attributes_latest",),
    "campaign_fbfs": ("attributes_latest",),
    "reach_by_title": ("content_detail",),
    "reach_by_brand": ("commercial_detail",),
}

#: Daily reach sketches: (detail table, item column).
REACH = {"reach_by_title": ("content_detail", "TITLE"), "reach_by_brand": ("commercial_detail", "BRAND_NAME")}


class Project:
    """``as_of`` is the snapshot date of the demographic models (default: the
    session's current date); ``updated_at`` adds their DBT_UPDATED_AT run stamp."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, as_of: dt.date | None = None,
                 window: Window | None = None, sources=None, updated_at: bool = False, locations: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.updated_at = updated_at
        self.locations = locations  # latest location of every device, where it is kept
        self.window = window
        self.src = sources or Sources(spark, sf_dir)
        self._models: dict[str, DataFrame] = {}

    def set_model(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. a table read back from storage) for ``name``."""
        self._models[name] = df

    def ref(self, name: str) -> DataFrame:
        if name not in self._models:
            self._models[name] = self._build(name)
        return self._models[name]

    def _build(self, name: str) -> DataFrame:
        s, w = self.src, self.window
        if name == "content_detail":
            return models.content_detail(s.content, s.genre_map, s.tz_map, w)
        if name == "content_summary":
            return models.content_summary(self.ref("content_detail"))
        if name == "commercial_detail":
            return models.commercial_detail(s.commercial, s.category_map, s.tz_map, w)
        if name == "commercial_summary":
            return models.commercial_summary(self.ref("commercial_detail"))
        if name == "standard_detail":
            return models.standard_detail(s.device, s.tz_map, w)
        if name == "standard_summary":
            return models.standard_summary(self.ref("standard_detail"))
        if name == "attributes_latest":
            return models.attributes_latest(s.demographics, s.device, self.as_of, self.updated_at, self.locations)
        if name == "agg_hh":
            return models.agg_hh(self.ref("attributes_latest"))
        if name == "agg_ind":
            return models.agg_ind(self.ref("attributes_latest"))
        if name == "agg_media":
            return models.agg_media(self.ref("content_detail"))
        if name == "campaign_nbc":
            return models.campaign(s.impressions, s.population, s.tz_map,
                                   self.ref("attributes_latest"), with_ue=False, window=w)
        if name == "campaign_fbfs":
            return models.campaign(s.impressions_fbfs, s.population_fbfs, s.tz_map,
                                   self.ref("attributes_latest"), with_ue=True, window=w)
        if name in REACH:
            detail, by = REACH[name]
            return sketches.daily_reach(apply_window(self.ref(detail), "PARTITION_DATE", w), [by])
        raise KeyError(f"unknown model {name!r}")

    def _levels(self, names) -> list[list[str]]:
        """``names`` plus their upstream models, grouped into dependency levels."""
        need: set[str] = set()

        def add(n):
            if n not in need:
                need.add(n)
                for d in MODEL_DEPS[n]:
                    add(d)

        for n in names:
            add(n)
        levels: list[list[str]] = []
        done: set[str] = set()
        while len(done) < len(need):
            level = [n for n in MODEL_DEPS if n in need and n not in done and set(MODEL_DEPS[n]) <= done]
            levels.append(level)
            done |= set(level)
        return levels

    def materialize(self, names, root: str, clustered: bool = False, threads: int = 4) -> dict[str, str]:
        """Write ``names`` and their upstream models under ``root`` and switch
        ``ref`` to the written tables.

        Models of one dependency level are independent: each is planned and
        written on its own thread (``threads`` concurrent Spark jobs, a build's
        model concurrency); the next level starts from the files just written.  This is what a build
        does before its tests run: every model is computed once, and checks
        read short plans over files.
        """
        from concurrent.futures import ThreadPoolExecutor

        from viewgrid.sinks.writers import write_model, write_table

        paths: dict[str, str] = {}

        def one(name: str):
            df = self.ref(name)
            path = f"{root.rstrip('/')}/{name}"
            if clustered:
                write_model(df, path, name)
            else:
                write_table(df, path)
            return name, path, df

        for level in self._levels(names):
            with ThreadPoolExecutor(max_workers=max(1, min(threads, len(level)))) as pool:
                results = list(pool.map(one, level))
            for name, path, df in results:
                paths[name] = path
                self._models[name] = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        return paths

    def build_all(self, root: str, mode: str = "overwrite") -> dict[str, str]:
        """Write every model under ``root`` in dependency order; return paths.

        Downstream models are built from the written upstream tables (the
        write is the lineage cut).
        """
        from viewgrid.sinks.writers import write_model

        paths = {}
        for name in MODEL_DEPS:
            df = self.ref(name)
            path = f"{root.rstrip('/')}/{name}"
            write_model(df, path, name, mode=mode)
            paths[name] = path
            self._models[name] = self.spark.read.parquet(path)
        return paths
