"""Distinct devices as mergeable sketches, stored by day.

An exact distinct count can't be added up: the reach of a week is not the sum
of seven daily reaches, so every new window reads the detail again.  A sketch
can.  One HyperLogLog sketch per day and item is written with the daily load;
the reach of an item over any dates is the union of those sketches, a few
kilobytes each, whatever the number of sessions behind them.  Overlaps of
audiences need set operations, which theta sketches have.

Both are aggregates with partial buffers, so a hot item is combined map-side and
no device id is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.operators.incremental import Window, apply_window

LG_K = 14  # 2**14 slots or entries: a standard error of 0.8 %
ERROR_BOUND = 0.03  # some 3.7 standard errors


def daily_reach(rows: DataFrame, by: list[str], date: str = "PARTITION_DATE", device: str = "AKKIO_ID") -> DataFrame:
    """(date, by, DEVICES, VIEWS): a sketch of the devices and the number of rows of each day and item."""
    return rows.groupBy(date, *by).agg(F.hll_sketch_agg(device, F.lit(LG_K)).alias("DEVICES"), F.count(F.lit(1)).alias("VIEWS"))


def reach_over(daily: DataFrame, by: list[str], window: Window | None = None, date: str = "PARTITION_DATE") -> DataFrame:
    """(by, approx_reach, views) over the dates of ``window``; on a table by date only their partitions are read."""
    rows = apply_window(daily, date, window)
    return rows.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("DEVICES")).alias("approx_reach"), F.sum("VIEWS").alias("views"))


def rolling_days(rows: DataFrame, days: int, date: str = "PARTITION_DATE") -> DataFrame:
    """Each row once for every window of ``days`` days that it lies in, by WINDOW_END (no later than the last date)."""
    last = rows.agg(F.max(date)).first()[0]
    ends = rows.withColumn("WINDOW_END", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_add(F.col(date), k))))
    return ends.where(F.col("WINDOW_END") <= F.lit(last))


def rolling_reach(daily: DataFrame, by: list[str], days: int, date: str = "PARTITION_DATE") -> DataFrame:
    """(by, WINDOW_END, approx_reach, views) of every window of ``days`` days: each day's sketch joins ``days`` unions."""
    return reach_over(rolling_days(daily, days, date), [*by, "WINDOW_END"])


# ------------------------------------------------------------ overlaps
def daily_audiences(parts: dict[str, DataFrame], date: str = "PARTITION_DATE", device: str = "AKKIO_ID") -> DataFrame:
    """(date, AUDIENCE, DEVICES): a theta sketch of each named audience's devices by day."""
    rows = reduce(DataFrame.unionByName, [df.select(date, device, F.lit(name).alias("AUDIENCE")) for name, df in parts.items()])
    return rows.groupBy(date, "AUDIENCE").agg(F.theta_sketch_agg(device, F.lit(LG_K)).alias("DEVICES"))


def audience_cells(daily: DataFrame, names: list[str], every: str, window: Window | None = None, date: str = "PARTITION_DATE") -> DataFrame:
    """(names as 0/1 flags, approx_devices): devices in exactly the flagged audiences, among those of audience ``every``
    or any other, for each of the 2**len(names) combinations; from the sketches alone, over the dates of ``window``."""
    one = apply_window(daily, date, window).groupBy("AUDIENCE").agg(F.theta_union_agg("DEVICES", F.lit(LG_K)).alias("DEVICES"))
    row = one.groupBy().agg(*(F.max(F.when(F.col("AUDIENCE") == n, F.col("DEVICES"))).alias(n) for n in [*names, every]))  # a row an audience
    empty = F.theta_difference(F.coalesce(*names, every), F.coalesce(*names, every))
    sketch = {n: F.coalesce(F.col(n), empty) for n in [*names, every]}
    cells: list[tuple[dict[str, int], Column]] = [({}, reduce(F.theta_union, sketch.values()))]
    for n in names:
        cells = [c for flags, s in cells for c in (({**flags, n: 1}, F.theta_intersection(s, sketch[n])), ({**flags, n: 0}, F.theta_difference(s, sketch[n])))]
    out = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in flags.items()), F.theta_sketch_estimate(s).alias("approx_devices")) for flags, s in cells))
    return row.where(F.coalesce(*names, every).isNotNull()).select(F.inline(out))
