"""Column profiles, NULL counts, join coverage and row-count audits.

An exact profile is one distributed job over all columns. Columns are turned into
(column, value) pairs, and the pairs are counted by two nested aggregations, so
no column's values ever meet in one task. The sketched profile is one
aggregation: a task sends one sketch per column, whatever the number of its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    TimestampType,
)

from aeroledger.functions.fixed_values import LOW_CARDINALITY


def _as_text(name: str, dtype: DataType) -> Column:
    """Text that differs exactly when the values differ."""
    col = F.col(f"`{name}`")
    if isinstance(dtype, (FloatType, DoubleType)):
        col = col + F.lit(0).cast(dtype)  # -0.0 and 0.0 are the same value
    elif isinstance(dtype, TimestampType):
        # Local time repeats when clocks go back, so the offset belongs to the text.
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return col.cast("string")


def _value_counts(df: DataFrame) -> DataFrame:
    """Rows per (column_name, value), NULL included."""
    text = df.select(*[_as_text(f.name, f.dataType).alias(f.name) for f in df.schema])
    pairs = text.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "value")
    return pairs.groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def _sketched(name: str, dtype: DataType) -> Column:
    """Text for a sketch of distinct values, which would skip an empty one."""
    return F.concat(F.lit("="), _as_text(name, dtype))


def _one_row_each(df: DataFrame, names: Sequence[str], per_column: Mapping[str, str]) -> DataFrame:
    """Turn one wide row of ``{column}_{suffix}`` into a row per column."""
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                *[F.col(f"`{n}_{suffix}`").alias(out) for suffix, out in per_column.items()],
            )
            for n in names
        ]
    )
    return df.select(F.explode(rows).alias("r")).select("r.*")


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, NULL rows and distinct values (NULL is one) of every column."""
    dtypes = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return (
        _value_counts(df)
        .groupBy("column_name")
        .agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("null_count"),
            F.count("*").alias("distinct_count"),
        )
        .select("column_name", dtypes[F.col("column_name")].alias("dtype"), "null_count", "distinct_count")
    )


def profile_numeric(df: DataFrame) -> DataFrame:
    """Smallest, largest and mean (2 decimals) value of int, bigint and double columns.

    Smallest and largest are text, because one column has to hold bigint and
    double values unchanged. A column of NULLs gives NULLs.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, (IntegerType, LongType, DoubleType))]
    stats = []
    for n in names:
        col = F.col(f"`{n}`")
        stats += [
            F.min(col).cast("string").alias(f"{n}_min"),
            F.max(col).cast("string").alias(f"{n}_max"),
            F.round(F.avg(col), 2).alias(f"{n}_avg"),
        ]
    wide = df.agg(*stats)
    return _one_row_each(wide, names, {"min": "min_value", "max": "max_value", "avg": "avg_value"})


def low_cardinality(df: DataFrame, k: int = LOW_CARDINALITY) -> DataFrame:
    """The values of every column that has fewer than ``k`` of them, NULL included.

    A first job marks, in one 64-bit mask per column, the slots to which a hash
    sends its values. A column never has fewer values than slots, so those with
    ``k`` slots or more are out; one row of masks reaches the driver. Only the
    columns left are read again, and only their values are shuffled and counted.
    """
    one = F.lit(1).cast("bigint")
    masks = df.agg(
        *[
            F.bit_or(F.call_function("shiftleft", one, F.pmod(F.xxhash64(_as_text(f.name, f.dataType)), F.lit(64)).cast("int"))).alias(str(i))
            for i, f in enumerate(df.schema)
        ]
    ).first()
    narrow = [n for n, mask in zip(df.columns, masks, strict=True) if mask is not None and (mask % 2**64).bit_count() < k]
    if not narrow:
        narrow = df.columns[:1]  # its values are counted below, and found too many
    values = _value_counts(df.select(*[f"`{n}`" for n in narrow])).select("column_name", "value")
    few = values.groupBy("column_name").agg(F.count("*").alias("n")).filter(F.col("n") < k)
    # An inner join, as Spark would move a semi join below the aggregation, where
    # the two sides no longer share their shuffle and the table is read twice.
    return values.join(few, "column_name").select("column_name", "value")


def sketch_columns(df: DataFrame, precision: int = 14) -> DataFrame:
    """A mergeable profile: column_name, dtype, rows, null_count and sketch of every column.

    One scan; a task sends one sketch of at most ``2 ** precision`` bytes per
    column. The rows of several parts of a table can be stored and merged later.
    """
    aggregates = []
    for f in df.schema:
        aggregates += [
            F.count("*").alias(f"{f.name}_rows"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"{f.name}_nulls"),
            F.hll_sketch_agg(_sketched(f.name, f.dataType), precision).alias(f"{f.name}_sketch"),
        ]
    dtypes = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    parts = _one_row_each(df.agg(*aggregates), df.columns, {"rows": "rows", "nulls": "null_count", "sketch": "sketch"})
    return parts.select("column_name", dtypes[F.col("column_name")].alias("dtype"), "rows", "null_count", "sketch")


def merge_sketches(parts: DataFrame) -> DataFrame:
    """Rows of :func:`sketch_columns`, one for each column of the whole."""
    return parts.groupBy("column_name", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"), F.hll_union_agg("sketch", True).alias("sketch")
    )


def profile_sketches(sketches: DataFrame) -> DataFrame:
    """The columns of :func:`profile_columns`, with an estimated distinct count.

    The standard error of the count is about ``0.8 / sqrt(2 ** precision)``:
    0.7 % at the default precision.
    """
    null = F.when(F.col("null_count") > 0, 1).otherwise(0)
    distinct = F.hll_sketch_estimate("sketch") + null
    return sketches.select("column_name", "dtype", "null_count", distinct.alias("distinct_count"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``{column}_nulls`` for each named column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def join_coverage(
    df: DataFrame, probe_col: str, by: Sequence[str] = (), facts: str | None = None
) -> DataFrame:
    """Rows of a left join that found a partner, in all or per group.

    A row counts as matched when ``probe_col`` is not NULL. With ``facts`` each
    row stands for that many facts. The percentage is 0 when there are no rows.
    """
    one = F.lit(1).cast("bigint") if facts is None else F.col(facts)
    zero = F.lit(0).cast("bigint")
    counts = df.groupBy(*by).agg(
        F.coalesce(F.sum(one), zero).alias("total"),
        F.coalesce(F.sum(F.when(F.col(probe_col).isNotNull(), one)), zero).alias("matched"),
    )
    share = F.try_divide(F.col("matched"), F.col("total")) * 100
    return counts.select(
        *by,
        "total",
        "matched",
        (F.col("total") - F.col("matched")).alias("unmatched"),
        F.coalesce(F.round(share, 1), F.lit(0.0)).alias("match_pct"),
    )


def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, row count and column count of each table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def audit_cleaning(raw: DataFrame, distinct: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows read, kept and dropped as copies by a silver job, and its output size."""
    counts = audit({"raw": raw, "distinct": distinct, "silver": silver})

    def of(table: str, col: str) -> Column:
        return F.max(F.when(F.col("table_name") == table, F.col(col)))

    return counts.agg(
        of("raw", "row_count").alias("bronze_rows"),
        of("distinct", "row_count").alias("rows_after_dedup"),
        (of("raw", "row_count") - of("distinct", "row_count")).alias("duplicates_removed"),
        of("silver", "row_count").alias("silver_rows"),
        of("silver", "column_count").alias("silver_columns"),
    )
