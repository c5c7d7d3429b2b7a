"""Flags, ranges and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positive_flag(col: str) -> Column:
    """True above zero, False otherwise, NULL for NULL."""
    return F.col(col) > 0


def temp_range(low: str, high: str) -> Column:
    """Spread to one decimal; NULL when either end is missing."""
    return F.round(F.col(high) - F.col(low), 1)


def exact_mean(col: str, digits: int, weight: str | None = None) -> Column:
    """Mean of values that are already rounded to at most four decimals.

    Means of rounded values often end on a rounding tie, and a floating-point
    sum then depends on the order of the rows. The sum is taken in decimals, so
    the result is the same however Spark splits the rows.
    """
    value = F.col(col).cast("decimal(18,4)")
    if weight is None:
        total, count = F.sum(value), F.count(col)
    else:
        total = F.sum(value * F.col(weight).cast("decimal(18,0)"))
        count = F.sum(F.when(F.col(col).isNotNull(), F.col(weight)))
    return F.round(F.try_divide(total.cast("double"), count), digits)
