"""Row-level checks observed while a table is written: the same report without reading the table again."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL
from viewgrid.operators import quality
from viewgrid.operators.quality import Check
from viewgrid.plans.runner import run_models, test_models as checked
from viewgrid.session import scratch_path
from viewgrid.sinks.writers import write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_rows_are_counted_once_in_every_layout(spark):
    checks = [Check("t", ("v",), "not_null"), Check("t", ("v",), "expression", ">= 3"), Check("t", ("v",), "range", (0, 5)), Check("t", ("v",), "accepted_values", [1, 2])]
    df = spark.range(3000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"), (F.col("id") % 700).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 10).alias("v"))
    want = sorted(quality.run_checks(df, checks).collect())
    for rows in (df, df.where("k < 0")):  # an empty table too
        for layout in ({}, {"cluster_by": ("d", "k")}, {"partition_by": ("d",), "cluster_by": ("k",)}):
            seen, path = Observation(), scratch_path(spark, "observed")
            write_table(rows, path, watch=(seen, quality.failing_counts(checks)), **layout)
            known = {c.key: seen.get[f"c{i}"] for i, c in enumerate(checks)}
            report = quality.run_checks(rows, checks, known)
            assert "Range (0, 3000" not in plan(report)
            if rows is df:
                assert sorted(report.collect()) == want and {r.failing_rows for r in report.collect()} == {300, 600, 1200, 2100}
                assert spark.read.parquet(path).count() == 3000
            else:
                assert {r.failing_rows for r in report.collect()} == {0}


def test_build_checks_what_it_wrote_without_reading_it(spark):
    out, known = scratch_path(spark, "observed-build"), {}
    run_models(spark, SF_SMALL, out, known=known)
    by_row = [c for c in quality.DECLARED_CHECKS if c.kind in quality.ROW_KINDS]
    assert set(known) == {c.key for c in by_row}
    assert sorted(checked(spark, out, known).collect()) == sorted(checked(spark, out).collect())
    for name in {c.table for c in by_row}:
        table = spark.read.parquet(f"{out}/{name}")
        assert "FileScan" not in plan(quality.run_checks(table, quality.row_checks(name), known))
        assert "FileScan" in plan(quality.run_checks(table, quality.row_checks(name)))

    again = {}
    run_models(spark, SF_SMALL, out, ["content_detail", "content_summary"], start="2024-01-02", end="2024-01-04", known=again)
    assert {k[0] for k in again} == {"content_summary"}  # a few dates of the detail say nothing of the rest
    assert sorted(checked(spark, out, again).collect()) == sorted(checked(spark, out).collect())
