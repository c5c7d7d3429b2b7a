"""Operators on whole rows: exact copies, repeated keys, unions, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType

from aeroledger.functions.fixed_values import OPERATION_COLUMNS
from aeroledger.operators.shaping import tag


def drop_copies(df: DataFrame, few: bool = False) -> DataFrame:
    """Keep one of each set of identical rows.

    Spark collapses copies inside each task before the shuffle, so a row with
    very many copies sends one row per task and makes no hot partition.

    ``few=True`` is for a table that is cheap to read and has few copies: only a
    fingerprint of each row is shuffled, and the rows whose fingerprint occurs
    once go through as they are. The others, copies and any rows that share a
    fingerprint by chance, are compared in full, so the result is the same. The
    table is read three times, and has to give the same rows each time.
    """
    return drop_copies_by(df, row_fingerprint(df)) if few else df.dropDuplicates()


def row_fingerprint(df: DataFrame) -> list[Column]:
    """128 bits of all values of a row, and which of them are NULL (a hash of values skips those)."""
    values = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values]) if values else F.lit("")
    return [F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), nulls, *values)]


def drop_copies_by(df: DataFrame, fingerprint: Sequence[Column]) -> DataFrame:
    """Keep one of each set of identical rows; ``fingerprint`` is equal for equal rows.

    Spark broadcasts the repeated fingerprints where they are measured to be small;
    else both sides are joined by them, and adaptive execution splits hot ones.
    """
    names = [f"_fingerprint_{i}" for i in range(len(fingerprint))]
    marked = df.withColumns(dict(zip(names, fingerprint, strict=True)))
    repeated = marked.groupBy(*names).agg(F.count("*").alias("_n")).filter("_n > 1").select(*names)
    single = marked.join(repeated, names, "left_anti").drop(*names)
    compared = marked.join(repeated, names, "left_semi").drop(*names)
    return single.unionAll(compared.dropDuplicates())


def in_ranges(df: DataFrame, by: Column) -> DataFrame:
    """Shuffle the rows into ranges of ``by``, kept as column ``_range``; copies of a row meet in one of them.

    Removing copies afterwards takes no second shuffle, and a table that is
    partitioned by something that grows with ``by`` can be written from the
    ranges as they are. Their bounds come from a sample, so much-used values of
    ``by`` are split, by the other columns. Spark reads the table twice for this.
    """
    # Spark groups by normalised floats, so a range of a float would not count as one of the groups.
    exact = [f.name for f in df.schema if not isinstance(f.dataType, FractionalType) or isinstance(f.dataType, DecimalType)]
    return df.withColumn("_range", by).repartitionByRange("_range", *[F.col(f"`{c}`") for c in exact])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts.

    A left join repeats fact rows for each of these, so check dimensions first.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def in_months(df: DataFrame, months: Sequence[int], col: str = "flight_month") -> DataFrame:
    """Rows of the given months; on a partition column this prunes directories."""
    return df.filter(F.col(col).isin(list(months)))


def union_operations(flights: DataFrame, cancelled: DataFrame, months: Sequence[int]) -> DataFrame:
    """Completed flights and the failed ones of the given months, with a status each."""
    completed = tag(flights, OPERATION_COLUMNS, "flight_status", "Completed")
    failed = in_months(cancelled, months).select(*OPERATION_COLUMNS, "flight_status")
    return completed.unionByName(failed)


def frequency(df: DataFrame, col: str, by_count: bool = False) -> DataFrame:
    """Rows per value, by value or with the most frequent first."""
    order = [F.col("count").desc()] if by_count else []
    return df.groupBy(col).count().orderBy(*order, F.col(col).asc_nulls_first())


def sample_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first rows by key, so that the sample is the same on every run."""
    return df.orderBy(key).limit(n)
