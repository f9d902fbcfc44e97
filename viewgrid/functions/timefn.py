"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start, end) -> Column:
    """Whole seconds from start to end, truncated toward zero (10.9 s -> 10).

    Same as the warehouse's DATEDIFF(SECOND, start, end); negative when
    end < start.
    """
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def local_time(ts, tz) -> Column:
    """UTC wall-clock timestamp (NTZ) -> local wall clock in zone ``tz`` (NTZ).

    Independent of the session time zone.  NULL zone -> NULL.
    """
    return F.convert_timezone(F.lit("UTC"), _c(tz), _c(ts))


def daypart_of(hour) -> Column:
    """Documented day-parts of a local hour: prime 20-23h, daytime 9-17h."""
    h = _c(hour)
    return (F.when(h.between(20, 22), F.lit("prime"))
            .when(h.between(9, 16), F.lit("daytime"))
            .when(h.isNotNull(), F.lit("other")))


def daypart(local_ts) -> Column:
    """Day-part of a local timestamp."""
    return daypart_of(F.hour(_c(local_ts)))
