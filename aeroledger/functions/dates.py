"""Dates and their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(col: str, fmt: str) -> Column:
    """Date from text; NULL, not an error, when the text does not fit the format."""
    return F.try_to_date(F.col(col), fmt)


def date_parts(col: str, prefix: str) -> dict[str, Column]:
    """``{prefix}_Year``, ``{prefix}_Month`` and ``{prefix}_Day`` as integers."""
    return {
        f"{prefix}_Year": F.year(col),
        f"{prefix}_Month": F.month(col),
        f"{prefix}_Day": F.dayofmonth(col),
    }


def weekday_name(col: str) -> Column:
    """Full English weekday name."""
    return F.date_format(col, "EEEE")
