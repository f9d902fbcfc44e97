"""Viewgrid: TV-viewership analytics as plain Spark DataFrame transformations.

Sub-packages
------------
sources    typed readers for the raw feeds and the driver test tables
functions  column builders (text cleaning, decodes, time, ratios, hashing)
operators  reusable DataFrame -> DataFrame building blocks (joins, aggregates,
           top-1, sessionisation, data-quality checks, incremental windows)
plans      the eleven daily models, documented analytics and audience work
sinks      table writers (overwrite, append, partition replace, keyed upsert)
streaming  Structured Streaming variant of the daily content load
registry   query + DuckDB-oracle registry used by ``__spark_entry__``
"""

from viewgrid.session import get_session, shared_dir  # noqa: F401
