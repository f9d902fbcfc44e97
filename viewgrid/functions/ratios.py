"""Safe ratios (ANSI mode raises on division by zero; these return NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; NULL when b is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct(a: Column, b: Column) -> Column:
    return 100 * ratio(a, b)


def safe_metric(a: Column, b: Column, digits: int = 2) -> Column:
    """Documented metric rule: round to ``digits``; 0, NaN, +-Inf -> NULL."""
    r = F.round(ratio(a, b), digits)
    bad = F.isnan(r) | (r == float("inf")) | (r == float("-inf")) | (r == 0)
    return F.when(~bad, r)
