"""Which source dates a model run processes.

Four modes, chosen in this order (SURVEY §2.11):

* changed      -- given dates, those whose rows differ from the last run (``operators.manifest``);
* batch window -- ``start`` and ``end`` given: ``date BETWEEN start AND end``
  (inclusive), also on a full refresh;
* high-water   -- the target exists: ``date > max(target date)``;
* full         -- everything.

The filter is applied before any join, on the partition column, so on a
date-partitioned source it becomes a ``PartitionFilters`` entry and only the
selected directories are listed and read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Window:
    start: dt.date | str | None = None
    end: dt.date | str | None = None
    after: dt.date | str | None = None   # high-water mark (exclusive)
    dates: tuple[dt.date, ...] | None = None

    @property
    def mode(self) -> str:
        if self.dates is not None:
            return "changed"
        if self.start is not None and self.end is not None:
            return "batch"
        if self.after is not None:
            return "incremental"
        return "full"

    def covers(self, date: str) -> bool:
        """Whether a run of the window replaces the date (ISO text) whole, even where no row of it is left."""
        if self.mode == "changed":
            return date in {str(d) for d in self.dates}
        return self.mode == "batch" and str(self.start) <= date <= str(self.end)

    def predicate(self, date_col: Column) -> Column | None:
        if self.mode == "changed":
            return date_col.isin([F.lit(d) for d in self.dates]) if self.dates else F.lit(False)
        if self.mode == "batch":
            return date_col.between(F.lit(_d(self.start)), F.lit(_d(self.end)))
        if self.mode == "incremental":
            return date_col > F.lit(_d(self.after))
        return None


FULL = Window()


def _d(x) -> dt.date:
    return dt.date.fromisoformat(x) if isinstance(x, str) else x


def apply_window(df: DataFrame, date_col: Column | str, window: Window | None) -> DataFrame:
    if window is None:
        return df
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    p = window.predicate(c)
    return df if p is None else df.filter(p)


def high_water(target: DataFrame | None, col: str = "PARTITION_DATE"):
    """max(target.col) as a Python value, or None for a missing/empty target.

    An empty target makes MAX NULL; the warehouse's ``date > NULL`` then
    selects nothing.  We treat NULL as "load everything" instead.
    """
    if target is None:
        return None
    return target.agg(F.max(col).alias("m")).first()["m"]


def window_for(target: DataFrame | None, start=None, end=None, col: str = "PARTITION_DATE") -> Window:
    """Resolve the run mode the way a model run does."""
    if start is not None and end is not None:
        return Window(start=start, end=end)
    hw = high_water(target, col)
    return Window(after=hw) if hw is not None else FULL
