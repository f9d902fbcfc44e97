"""Readers for the driver-provided parquet tables.

Each table is read lazily with ``spark.read.parquet``; Catalyst prunes the
columns and pushes filters into the scan, so callers never pre-select.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Name -> DataFrame accessor over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @lru_cache(maxsize=None)  # noqa: B019 - one Tables per query build
    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)
