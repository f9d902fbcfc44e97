"""Run models into a warehouse folder, the way a scheduled model run does.

    python -m viewgrid run  --sf DIR --out DIR [--select a,b] [--start D --end D] [--full-refresh]
    python -m viewgrid test --sf DIR --out DIR
    python -m viewgrid build ...            (run, then test)
    python -m viewgrid purge --sf DIR --out DIR     (remove opted-out devices from the built tables)

Per model the write strategy follows its materialisation:

* ``replace``  -- incremental detail/campaign tables, date-partitioned: the
  run's dates are recomputed and their partitions replaced (idempotent, so a
  re-run or an overlapping back-fill never duplicates rows);
* ``upsert``   -- the incremental commercial summary: keyed on
  (PARTITION_DATE, AKKIO_ID);
* ``table``    -- everything else: full rebuild (overwrite).

The run window is ``--start/--end`` when given (also on a full refresh),
otherwise everything after the target's high-water mark, otherwise all.
``--changed`` reloads, in place of a window, the dates of each feed whose rows differ
from the last such run (``operators.manifest``): late, corrected and removed rows.

The latest location of every device is kept in ``<out>/_latest_location`` and takes in the
dates of each run; only a full refresh, or ``--changed`` with dates that lost or changed
rows, reads the whole device history.

Upstream models that are not selected are read from the warehouse when they
exist there, and built in memory otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewgrid.operators import manifest, quality
from viewgrid.operators.incremental import apply_window, window_for
from viewgrid.operators.manifest import Manifest
from viewgrid.plans import models
from viewgrid.plans.project import MODEL_DEPS, REACH, Project
from viewgrid.session import scratch_path
from viewgrid.sinks import purge, writers
from viewgrid.sources.binding import BoundSources
from viewgrid.sources.fixtures import Sources

STRATEGY = {
    "content_detail": "replace", "commercial_detail": "replace", "standard_detail": "replace",
    "campaign_nbc": "replace", "campaign_fbfs": "replace", "commercial_summary": "upsert",
    "reach_by_title": "replace", "reach_by_brand": "replace",
}
UPSERT_KEYS = ["PARTITION_DATE", "AKKIO_ID"]
#: Feed and date column behind each dated model; models over another model go by that one's.
FEED = {
    "content_detail": ("content", "date_partition"), "commercial_detail": ("commercial", "date_partition"),
    "standard_detail": ("device", "date_partition"), "campaign_nbc": ("impressions", "imp_ts"), "campaign_fbfs": ("impressions_fbfs", "imp_ts"),
}
BASE = {"commercial_summary": "commercial_detail", "reach_by_title": "content_detail", "reach_by_brand": "commercial_detail"}


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if there is none; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _kept_locations(spark: SparkSession, sources, out: str, start, end, rebuild: bool) -> DataFrame:
    """Latest locations from the kept state, once it has taken in the device rows of the run."""
    state = models.location_state(spark, f"{out}/_latest_location")
    have = None if rebuild else state.read()
    if have is None:
        state.rebuild(sources.device)
    else:
        window = window_for(have, start, end, "date_partition")
        state.merge(apply_window(sources.device, "date_partition", window))
    return models.located(state.read())


def run_models(spark: SparkSession, sources, out: str, select=None, start=None, end=None,
               full_refresh: bool = False, as_of: dt.date | None = None, changed: bool = False,
               known: dict[tuple, int] | None = None) -> dict[str, str]:
    """Run the selected models (default: all) in dependency order; return
    model -> run mode ('full', 'batch', 'incremental', 'table').

    ``sources`` is a folder of the driver's tables or any binding of the feeds
    (``sources.fixtures.Sources``, ``sources.binding.BoundSources``).
    ``known`` takes in the failing rows of the row-level checks of every table that the run
    writes whole, counted during the write; dates replaced or rows upserted tell nothing of the rest of a table.
    """
    if isinstance(sources, str):
        sources = Sources(spark, sources)
    out = out.rstrip("/")
    selected = list(MODEL_DEPS) if not select else [m for m in MODEL_DEPS if m in set(select)]
    found = {}  # feed -> its fingerprints, if the run goes by them
    if changed:
        for feed, date in {FEED[m] for m in selected if m in FEED}:
            path = scratch_path(spark, "fingerprints")
            manifest.fingerprints(getattr(sources, feed), F.to_date(date)).write.parquet(path)
            found[feed] = spark.read.parquet(path)
    kept = None
    if "attributes_latest" in selected:
        book = Manifest(spark, f"{out}/_manifest/locations")
        seen = found.get("device")
        if seen is None and changed:
            seen = manifest.fingerprints(sources.device, "date_partition")
        kept = _kept_locations(spark, sources, out, start, end, full_refresh or (changed and bool(book.window(seen).dates)))
        if changed:
            book.record(seen)
    base = Project(spark, as_of=as_of, sources=sources, updated_at=True, locations=kept)
    for name in MODEL_DEPS:                      # upstream models already in the warehouse
        if name not in selected:
            existing = _read(spark, f"{out}/{name}")
            if existing is not None:
                base.set_model(name, existing)
    modes = {}
    for name in selected:
        path = f"{out}/{name}"
        strategy = STRATEGY.get(name, "table")
        target = None if full_refresh else _read(spark, path)
        checks = [] if known is None or (target is not None and strategy != "table") else quality.row_checks(name)
        seen = Observation()
        watch = (seen, quality.failing_counts(checks))
        if strategy == "table":
            df = base.ref(name)
            writers.write_model(df, path, name, watch=watch)
            modes[name] = "table"
        else:
            feed = FEED[BASE.get(name, name)][0]
            book = Manifest(spark, f"{out}/_manifest/{name}")
            if changed and feed not in found:
                found[feed] = manifest.fingerprints(getattr(sources, feed), F.to_date(FEED[BASE.get(name, name)][1]))
            if changed and target is not None:
                window = book.window(found[feed])
            else:
                window = window_for(target, start, end)
            p = Project(spark, as_of=as_of, window=window, sources=sources, updated_at=True)
            for dep in MODEL_DEPS[name]:
                p.set_model(dep, base.ref(dep))
            if name == "commercial_summary":     # the summary windows its (already written) detail
                df = models.commercial_summary(base.ref("commercial_detail"), window)
            else:
                df = p.ref(name)
            df = writers.described(df, name)
            cluster = (REACH[name][1],) if name in REACH else ("AKKIO_ID",)
            if target is None:
                writers.write_table(df, path, mode="overwrite", partition_by=("PARTITION_DATE",), cluster_by=cluster, watch=watch)
            elif strategy == "upsert" and window.mode != "changed":
                writers.upsert(df, path, UPSERT_KEYS, cluster_by=cluster)
            else:
                writers.replace_partitions(df, path, cluster_by=cluster, window=window)
            if changed:
                book.record(found[feed])
            modes[name] = window.mode
        if checks:
            counts = seen.get
            known.update({c.key: counts[f"c{i}"] for i, c in enumerate(checks)})
        base.set_model(name, _read(spark, path))
    return modes


def purge_optouts(spark: SparkSession, sources, out: str) -> dict[str, int]:
    """Remove opted-out devices from every table with device rows and from the kept locations; table -> files rewritten.

    Summaries per day and market and the reach sketches hold no ids and stay as they are until they are rebuilt.
    """
    if isinstance(sources, str):
        sources = Sources(spark, sources)
    out, done = out.rstrip("/"), {}
    ids = sources.optout.select("hash")
    for name in MODEL_DEPS:
        table = _read(spark, f"{out}/{name}")
        id_col = next((c for c in ("AKKIO_ID", "AKKIO_HH_ID") if table is not None and c in table.columns), None)
        if id_col:
            part = ("PARTITION_DATE",) if STRATEGY.get(name) else writers.MODEL_LAYOUT[name][0]
            done[name] = purge.purge(spark, f"{out}/{name}", ids, id_col, part)
    models.location_state(spark, f"{out}/_latest_location").forget(ids)
    return done


def test_models(spark: SparkSession, out: str, known: dict[tuple, int] | None = None) -> DataFrame:
    """The declared checks over the tables present in the warehouse; ``known`` as ``run_models`` left it."""
    tables = {}
    for name in MODEL_DEPS:
        df = _read(spark, f"{out.rstrip('/')}/{name}")
        if df is not None:
            tables[name] = df
    return quality.report(tables, known=known)


def main(argv=None) -> int:
    import argparse

    from viewgrid.session import get_session

    ap = argparse.ArgumentParser(prog="viewgrid")
    ap.add_argument("command", choices=["run", "test", "build", "purge"])
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--sf", help="folder with the driver's test tables")
    where.add_argument("--sources", help="JSON file that binds every feed to a path, format and columns")
    ap.add_argument("--out", required=True, help="warehouse folder (shared by the cluster)")
    ap.add_argument("--select", default="", help="comma-separated models (default: all)")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--changed", action="store_true", help="reload the dates whose source rows differ from the last such run")
    ap.add_argument("--as-of", help="snapshot date of the demographic models (default: today)")
    ap.add_argument("--master", default="", help="e.g. local[8]; default: as configured by spark-submit")
    a = ap.parse_args(argv)
    spark = get_session(master=a.master)
    rc, known = 0, {}
    sources = BoundSources.from_file(spark, a.sources) if a.sources else Sources(spark, a.sf)
    if a.command == "purge":
        for k, v in purge_optouts(spark, sources, a.out).items():
            print(f"{k}: {v} files rewritten")
    if a.command in ("run", "build"):
        modes = run_models(spark, sources, a.out, [s for s in a.select.split(",") if s] or None, a.start, a.end,
                           a.full_refresh, dt.date.fromisoformat(a.as_of) if a.as_of else None, a.changed, known)
        for k, v in modes.items():
            print(f"{k}: {v}")
    if a.command in ("test", "build"):
        rep = test_models(spark, a.out, known)
        rep.orderBy("table_name", "column_name", "check_name").show(100, truncate=False)
        try:
            quality.raise_on_error(rep)
        except AssertionError as e:
            print(e)
            rc = 1
    return rc
