"""Projections that shape a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by a map; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def trim_strings(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Strip outer blanks from every string column in one projection."""
    skip = set(exclude)
    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in skip]
    return df.withColumns({c: F.trim(c) for c in strings})


def upper_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Upper-case the named columns."""
    return df.withColumns({c: F.upper(c) for c in cols})


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the columns of a table contract, in its order."""
    return df.select(*columns)


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def tag(df: DataFrame, cols: Sequence[str], name: str, value: Any) -> DataFrame:
    """Keep some columns and add a constant one."""
    return df.select(*cols, F.lit(value).alias(name))


def nullify(df: DataFrame, cols: Iterable[str], condition: Column) -> DataFrame:
    """Blank columns where the condition holds; a NULL condition keeps the value."""
    keep = ~F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(keep, F.col(c)) for c in cols})


def fill(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a default, column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def add_load_ts(df: DataFrame, name: str = "Silver_Load_Timestamp") -> DataFrame:
    """Add the time of the run, the same for every row."""
    return df.withColumn(name, F.current_timestamp())
