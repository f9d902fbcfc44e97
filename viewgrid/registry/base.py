"""Registry plumbing: queries, their DuckDB oracles, and oracle CTE assembly.

An oracle is written as a final SELECT plus the names of the relations it
reads (fixtures and model CTEs); ``oracle`` resolves those names recursively
into one ``WITH`` clause in dependency order, so every oracle is a single
self-contained statement over the driver's pre-registered tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewgrid.plans.project import Project
from viewgrid.session import scratch_path
from viewgrid.sources.fixtures import FX_DEPS, ORACLE_FX

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# name -> (CTE body, dependencies) for oracle-side relations beyond fixtures
ORACLE_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    name: (body, tuple(d for d in FX_DEPS[name] if d.startswith("fx_"))) for name, body in ORACLE_FX.items()
}


def cte(name: str, body: str, *deps: str) -> None:
    ORACLE_CTES[name] = (body, deps)


def oracle(select: str, *deps: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        if n not in ORACLE_CTES:
            return  # a driver table
        for d in ORACLE_CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return select.strip()
    withs = ",\n".join(f"{n} AS ({ORACLE_CTES[n][0].strip()})" for n in order)
    body = select.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {withs},\n{body[5:]}"
    return f"WITH {withs}\n{body}"


def register(name: str, sql: str | None = None, deps: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql, *deps)
        return fn

    return wrap


#: Snapshot date of the registered queries, so that their oracles can state it.
AS_OF = dt.date(2024, 1, 31)


def project(spark: SparkSession, sf_dir: str) -> Project:
    return Project(spark, sf_dir, as_of=AS_OF)


def written(spark: SparkSession, sf_dir: str, *names: str) -> Project:
    """A project whose models ``names`` are written once and read back: for queries that read one several times."""
    p = project(spark, sf_dir)
    p.materialize(names, scratch_path(spark, "read-again"))
    return p
