"""Declarative data-quality checks -> one report DataFrame.

A check is (table, columns, kind, argument, severity).  Row-level kinds
(not_null, expression, range, accepted_values) of one table are evaluated in a
single aggregation pass (one ``count_if`` per check), or observed while the
table is written, which costs no pass of their own; key kinds (unique,
unique_combination) are one partial+final hash aggregate per distinct key set.
The report has one row per check:
(table_name, column_name, check_name, severity, failing_rows, status).

Semantics follow the usual declarative test rules: a row fails an expression
or range test only when the predicate is false (NULL passes); ``unique``
ignores NULL values; the failure count of a key test is the number of key
values that occur more than once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    table: str
    columns: tuple[str, ...]
    kind: str            # not_null | unique | unique_combination | expression | range | accepted_values
    arg: object = None   # expression text ('>= 0'), (min, max), or list of values
    severity: str = "error"

    @property
    def key(self) -> tuple[str, str, str]:
        return self.table, self.column_name, self.check_name

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def check_name(self) -> str:
        if self.kind == "expression":
            return f"expression_is_true({self.arg})"
        if self.kind == "range":
            return f"accepted_range({self.arg[0]},{self.arg[1]})"
        if self.kind == "accepted_values":
            return f"accepted_values({','.join(str(v) for v in self.arg)})"
        return self.kind


def _nn(t, *cols):
    return [Check(t, (c,), "not_null") for c in cols]


def _expr(t, c, e, sev="error"):
    return Check(t, (c,), "expression", e, sev)


# The 64 tests declared for the models.
DECLARED_CHECKS: list[Check] = [
    Check("content_summary", ("PARTITION_DATE", "AKKIO_ID"), "unique_combination"),
    *_nn("content_summary", "VIEWED_DATE", "AKKIO_ID", "TOTAL_VIEWING_SECONDS"),
    _expr("content_summary", "TOTAL_VIEWING_SECONDS", ">= 0"),
    *_nn("content_detail", "PARTITION_DATE", "VIEWED_DATE", "AKKIO_ID", "SESSION_START_TIME_UTC",
         "SESSION_END_TIME_UTC", "TOTAL_SECONDS"),
    _expr("content_detail", "TOTAL_SECONDS", ">= 0"),
    Check("commercial_summary", ("PARTITION_DATE", "AKKIO_ID"), "unique_combination"),
    *_nn("commercial_summary", "PARTITION_DATE", "TOTAL_AD_VIEWS", "TOTAL_AD_SECONDS"),
    _expr("commercial_summary", "TOTAL_AD_VIEWS", ">= 0"),
    _expr("commercial_summary", "TOTAL_AD_SECONDS", ">= 0"),
    *_nn("commercial_detail", "PARTITION_DATE", "VIEWED_DATE", "AKKIO_ID", "AD_MATCH_START_TIME_UTC",
         "AD_MATCH_END_TIME_UTC"),
    _expr("commercial_detail", "AD_LENGTH", ">= 0", "warn"),
    *_nn("standard_detail", "PARTITION_DATE", "ACTIVITY_DATE", "AKKIO_ID", "TOTAL_SECONDS"),
    _expr("standard_detail", "TOTAL_SECONDS", ">= 0"),
    *_nn("campaign_nbc", "PARTITION_DATE", "IMPRESSION_DATE", "AKKIO_ID", "IMPRESSION_TIMESTAMP"),
    _expr("campaign_nbc", "MARKET_TV_POPULATION", "> 0", "warn"),
    *_nn("campaign_fbfs", "PARTITION_DATE", "IMPRESSION_DATE", "AKKIO_ID", "IMPRESSION_TIMESTAMP"),
    _expr("campaign_fbfs", "MARKET_TV_POPULATION", "> 0", "warn"),
    _expr("campaign_fbfs", "MARKET_UE_POPULATION", "> 0", "warn"),
    Check("attributes_latest", ("TV_ID",), "unique_combination"),
    *_nn("attributes_latest", "PARTITION_DATE", "AKKIO_ID"),
    Check("attributes_latest", ("AKKIO_ID",), "unique"),
    *_nn("attributes_latest", "TV_ID"),
    Check("attributes_latest", ("TV_ID",), "unique"),
    *_nn("attributes_latest", "AKKIO_HH_ID"),
    Check("attributes_latest", ("AKKIO_HH_ID",), "unique"),
    Check("attributes_latest", ("AGE",), "range", (18, 100), "warn"),
    Check("attributes_latest", ("HOUSEHOLD_INCOME_K",), "range", (0, 500), "warn"),
    Check("attributes_latest", ("ADULT_HOUSEHOLD_SIZE",), "range", (0, 20), "warn"),
    Check("agg_ind", ("AKKIO_ID",), "unique_combination"),
    *_nn("agg_ind", "AKKIO_ID", "AKKIO_HH_ID", "WEIGHT"),
    Check("agg_ind", ("WEIGHT",), "accepted_values", (1,)),
    Check("agg_ind", ("AGE",), "range", (18, 100), "warn"),
    *_nn("agg_ind", "PARTITION_DATE"),
    Check("agg_hh", ("AKKIO_HH_ID",), "unique_combination"),
    *_nn("agg_hh", "AKKIO_HH_ID"),
    Check("agg_hh", ("AKKIO_HH_ID",), "unique"),
    *_nn("agg_hh", "HH_WEIGHT"),
    Check("agg_hh", ("INCOME",), "range", (0, 500), "warn"),
    *_nn("agg_hh", "PARTITION_DATE"),
]

_OPS = {">=": lambda c, v: c >= v, ">": lambda c, v: c > v, "<=": lambda c, v: c <= v,
        "<": lambda c, v: c < v, "=": lambda c, v: c == v, "!=": lambda c, v: c != v}


def _expression(col: str, expr: str) -> Column:
    op, value = expr.split()
    return _OPS[op](F.col(col), F.lit(float(value) if "." in value else int(value)))


def failing_row_condition(check: Check) -> Column:
    """Condition true on a failing row (row-level kinds only)."""
    c = check.columns[0]
    if check.kind == "not_null":
        return F.col(c).isNull()
    if check.kind == "expression":
        return ~_expression(c, check.arg)
    if check.kind == "range":
        lo, hi = check.arg
        return ~((F.col(c) >= lo) & (F.col(c) <= hi))
    if check.kind == "accepted_values":
        return ~F.col(c).isin(*check.arg)
    raise ValueError(check.kind)


ROW_KINDS = {"not_null", "expression", "range", "accepted_values"}


def row_checks(table: str, checks: list[Check] | None = None) -> list[Check]:
    """The checks of ``table`` that look at one row at a time."""
    return [c for c in (DECLARED_CHECKS if checks is None else checks) if c.table == table and c.kind in ROW_KINDS]


def failing_counts(checks: list[Check]) -> list[Column]:
    """An aggregate per row-level check, to be observed while its table is written (``sinks.writers.write_table``)."""
    return [F.count_if(failing_row_condition(c)).alias(f"c{i}") for i, c in enumerate(checks)]


def run_checks(df: DataFrame, checks: list[Check], known: dict[tuple, int] | None = None) -> DataFrame:
    """Evaluate ``checks`` (all for the same table) over ``df``; row-level checks
    whose failing rows are all ``known`` (by ``Check.key``) read no rows."""
    parts: list[DataFrame] = []
    by_row = [c for c in checks if c.kind in ROW_KINDS]
    if by_row:
        if known is not None and all(c.key in known for c in by_row):
            counts = df.sparkSession.range(1).select(*[F.lit(known[c.key]).cast("long").alias(f"c{i}") for i, c in enumerate(by_row)])
        else:
            counts = df.agg(*failing_counts(by_row))
        entries = F.array(*[F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column_name).alias("column_name"),
                                     F.lit(c.check_name).alias("check_name"), F.lit(c.severity).alias("severity"),
                                     F.col(f"c{i}").alias("failing_rows"))
                            for i, c in enumerate(by_row)])
        parts.append(counts.select(F.explode(entries).alias("r")).select("r.*"))
    dup_cache: dict[tuple, DataFrame] = {}
    for c in checks:
        if c.kind not in ("unique", "unique_combination"):
            continue
        key = (c.columns, c.kind == "unique")
        if key not in dup_cache:
            src = df
            if c.kind == "unique":
                src = src.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in c.columns]))
            dup_cache[key] = (src.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n"))
                              .agg(F.count_if(F.col("n") > 1).alias("failing_rows")))
        parts.append(dup_cache[key].select(
            F.lit(c.table).alias("table_name"), F.lit(c.column_name).alias("column_name"),
            F.lit(c.check_name).alias("check_name"), F.lit(c.severity).alias("severity"), "failing_rows"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("status", F.when(F.col("failing_rows") == 0, F.lit("pass"))
                          .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))


def report(tables: dict[str, DataFrame], checks: list[Check] = DECLARED_CHECKS, known: dict[tuple, int] | None = None) -> DataFrame:
    """Report for every check whose table is in ``tables``; ``known`` as in ``run_checks``."""
    parts = []
    for name, df in tables.items():
        cs = [c for c in checks if c.table == name]
        if cs:
            parts.append(run_checks(df, cs, known))
    return reduce(lambda a, b: a.unionByName(b), parts)


def raise_on_error(report_df: DataFrame) -> None:
    """Fail the run if any error-severity check failed (warns only report)."""
    bad = report_df.filter(F.col("status") == "fail").select("table_name", "column_name", "check_name").collect()  # a row for each declared check at most
    if bad:
        raise AssertionError(f"data-quality failures: {[tuple(r) for r in bad]}")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once (for mapping-table checks)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def row_count_trend(counts: DataFrame, group_col: str, date_col: str, count_col: str,
                    lookback: int = 7, z: float = 3.0) -> DataFrame:
    """Flag days whose row count deviates from the previous ``lookback`` days, and days without rows.

    ``counts`` has one row per (group, day) -- a bounded table -- and the
    window runs per group.  Days from a group's first to the last day of any
    group are all reported, so a feed that stopped shows up as ``missing``.
    Rows without a day are no part of the trend.
    """
    from pyspark.sql import Window

    counts = counts.filter(F.col(date_col).isNotNull())
    whole = Window.partitionBy(F.lit(0))  # over one row per group
    span = counts.groupBy(group_col).agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    span = span.withColumn("hi", F.max("hi").over(whole))
    days = span.select(group_col, F.explode(F.sequence("lo", "hi")).alias(date_col))
    counts = days.join(counts, [group_col, date_col], "left").withColumn(count_col, F.coalesce(count_col, F.lit(0)))
    w = Window.partitionBy(group_col).orderBy(date_col).rowsBetween(-lookback, -1)
    mean = F.avg(count_col).over(w)
    sd = F.stddev_samp(count_col).over(w)
    zscore = F.try_divide(F.col(count_col) - mean, sd)
    return (counts.withColumn("trailing_mean", F.round(mean, 4))
            .withColumn("z_score", F.round(zscore, 4))
            .withColumn("anomaly", F.coalesce(F.abs(F.col("z_score")) > z, F.lit(False)))
            .withColumn("missing", F.col(count_col) == 0))
