"""Registry: data-quality checks.  The oracle SQL is generated
from the same declarative check list, spelled in SQL."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from viewgrid.operators import quality
from viewgrid.operators.quality import DECLARED_CHECKS, Check
from viewgrid.plans.project import MODEL_DEPS
from viewgrid.registry.base import project, register
from viewgrid.session import scratch_path

MODEL_TABLES = sorted({c.table for c in DECLARED_CHECKS})


def _sql_cond(c: Check) -> str:
    col = c.columns[0]
    if c.kind == "not_null":
        return f"{col} IS NULL"
    if c.kind == "expression":
        return f"NOT ({col} {c.arg})"
    if c.kind == "range":
        return f"NOT ({col} >= {c.arg[0]} AND {col} <= {c.arg[1]})"
    if c.kind == "accepted_values":
        return f"NOT ({col} IN ({', '.join(str(v) for v in c.arg)}))"
    raise ValueError(c.kind)


def _sql_check(c: Check) -> str:
    head = (f"SELECT '{c.table}' AS table_name, '{c.column_name}' AS column_name, "
            f"'{c.check_name}' AS check_name, '{c.severity}' AS severity, ")
    if c.kind in quality.ROW_KINDS:
        return head + f"count(*) FILTER (WHERE {_sql_cond(c)}) AS failing_rows FROM {c.table}"
    cols = ", ".join(c.columns)
    where = (" WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in c.columns)) if c.kind == "unique" else ""
    return head + f"count(*) AS failing_rows FROM (SELECT {cols} FROM {c.table}{where} GROUP BY {cols} HAVING count(*) > 1)"


def _sql_report(checks: list[Check]) -> str:
    body = "\nUNION ALL ".join(_sql_check(c) for c in checks)
    return (f"SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({body})")


def _read_again(checks: list[Check]) -> list[str]:
    """Models that the checks read more than once: by several passes over a checked table, or as the upstream of several."""
    uses: Counter = Counter()
    for t in {c.table for c in checks}:
        own = [c for c in checks if c.table == t]
        passes = len({(c.columns, c.kind) for c in own if c.kind not in quality.ROW_KINDS}) + any(c.kind in quality.ROW_KINDS for c in own)
        todo = [t]
        while todo:
            m = todo.pop()
            uses[m] += passes if m == t else 1
            todo += MODEL_DEPS[m]
    return [m for m, n in uses.items() if n > 1]


def _register_dq(name: str, pred):
    checks = [c for c in DECLARED_CHECKS if pred(c)]
    tables = sorted({c.table for c in checks})

    @register(name, _sql_report(checks), tuple(tables))
    def q(spark, sf):
        p = project(spark, sf)
        p.materialize(_read_again(checks), scratch_path(spark, "dq_build"))  # the rest is checked in one pass, unwritten
        return quality.report({t: p.ref(t) for t in tables}, checks)
    return q


_register_dq("dq_not_null", lambda c: c.kind == "not_null")
_register_dq("dq_unique", lambda c: c.kind == "unique")
_register_dq("dq_unique_combo", lambda c: c.kind == "unique_combination")
_register_dq("dq_expression", lambda c: c.kind == "expression")
_register_dq("dq_range", lambda c: c.kind == "range")
_register_dq("dq_accepted_values", lambda c: c.kind == "accepted_values")
_register_dq("dq_severity", lambda c: c.severity == "warn")
_register_dq("dq_report", lambda c: True)


@register("dq_row_count_trend", """
WITH counts AS (
  SELECT 'content_detail' AS table_name, PARTITION_DATE AS day, count(*) AS row_count FROM content_detail GROUP BY ALL
  UNION ALL SELECT 'commercial_detail', PARTITION_DATE, count(*) FROM commercial_detail GROUP BY ALL
  UNION ALL SELECT 'standard_detail', PARTITION_DATE, count(*) FROM standard_detail GROUP BY ALL),
days AS (
  SELECT table_name, CAST(unnest(generate_series(min(day), (SELECT max(day) FROM counts), INTERVAL 1 DAY)) AS DATE) AS day
  FROM counts GROUP BY table_name),
filled AS (
  SELECT d.table_name, d.day, coalesce(c.row_count, 0) AS row_count
  FROM days d LEFT JOIN counts c ON c.table_name = d.table_name AND c.day = d.day)
SELECT table_name, day, row_count,
  round(avg(row_count) OVER w, 4) AS trailing_mean,
  round((row_count - avg(row_count) OVER w) / nullif(stddev_samp(row_count) OVER w, 0), 4) AS z_score,
  coalesce(abs(round((row_count - avg(row_count) OVER w) / nullif(stddev_samp(row_count) OVER w, 0), 4)) > 3.0, false) AS anomaly,
  row_count = 0 AS missing
FROM filled
WINDOW w AS (PARTITION BY table_name ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
          ("content_detail", "commercial_detail", "standard_detail"))
def dq_row_count_trend(spark, sf):
    p = project(spark, sf)
    counts = None
    for t in ("content_detail", "commercial_detail", "standard_detail"):
        c = p.ref(t).groupBy(F.col("PARTITION_DATE").alias("day")).agg(F.count(F.lit(1)).alias("row_count")) \
            .select(F.lit(t).alias("table_name"), "day", "row_count")
        counts = c if counts is None else counts.unionByName(c)
    return quality.row_count_trend(counts, "table_name", "day", "row_count")
