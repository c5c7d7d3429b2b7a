"""The whole run: raw CSV -> bronze -> silver -> gold parquet tables.

Tables are handed on through their files, so a job that is run again after a
failure replaces only its own table, and every gold job reads only the columns
and months it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aeroledger.functions.fixed_values import (
    GOLD_PARTITIONS,
    RAW_FILES,
    SILVER_PARTITIONS,
    SILVER_SCHEMAS,
)
from aeroledger.operators.profiling import audit
from aeroledger.operators.rows import drop_copies, in_ranges
from aeroledger.plans import gold, states
from aeroledger.plans.silver import CLEANING, SILVER, raw_day
from aeroledger.sources.files import ingest, read_table, replace_table, table_path
from aeroledger.sources.jdbc import write_jdbc

# Gold table -> (builder, silver tables it reads, in the builder's order).
GOLD = {
    "flight_performance": (gold.flight_performance, ["flights", "airports"]),
    "weather_delay_impact": (gold.weather_delay_impact, ["flights", "weather", "airports"]),
    "cancellation_analysis": (gold.cancellation_analysis, ["cancelled", "airports"]),
    "weather_cancellation": (gold.weather_cancellation, ["cancelled", "weather", "airports"]),
    "ops_summary": (gold.ops_summary, ["flights", "cancelled", "airports"]),
}


def read_silver(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A written silver table in its contract's column order."""
    return read_table(spark, table_path(f"{base}/silver", name), SILVER_SCHEMAS[name])


def build_bronze(spark: SparkSession, name: str, raw: str, base: str) -> None:
    """Ingest one raw CSV data set."""
    ingest(spark, name, raw, f"{base}/bronze")


@dataclass(frozen=True)
class Cleaned:
    """What a silver job has read and written."""

    bronze_rows: int
    rows_after_dedup: int
    duplicates_removed: int
    silver_rows: int
    silver_columns: int


def build_silver(spark: SparkSession, name: str, base: str) -> Cleaned:
    """Write one silver table from its bronze table; rows are counted on their way, so nothing is read again for it.

    A table of months is shuffled once, into ranges of days: that brings copies
    together and lays out the files too. The bronze rows are counted behind that
    shuffle, because they are also read for the bounds of the ranges.
    """
    counts = {step: Observation() for step in ("bronze", "distinct", "silver")}

    def counted(df: DataFrame, step: str) -> DataFrame:
        return df.observe(counts[step], F.count("*").alias("rows"))

    bronze = read_table(spark, table_path(f"{base}/bronze", name))
    months = SILVER_PARTITIONS[name]
    dealt = in_ranges(bronze, raw_day(name)) if months else bronze
    distinct = counted(drop_copies(counted(dealt, "bronze")).drop("_range"), "distinct")
    table = CLEANING[name](distinct)
    replace_table(counted(table, "silver"), table_path(f"{base}/silver", name), months, rebalance=False)
    read, kept, written = (observed.get["rows"] for observed in counts.values())
    return Cleaned(read, kept, read - kept, written, len(table.columns))


def build_gold(spark: SparkSession, name: str, base: str) -> None:
    """Write one gold table from its silver tables."""
    build, sources = GOLD[name]
    table = build(*[read_silver(spark, base, s) for s in sources])
    replace_table(table, table_path(f"{base}/gold", name), GOLD_PARTITIONS[name])


def update_gold(spark: SparkSession, base: str, months: Sequence[tuple[int, int]] | None = None) -> None:
    """Write all gold tables from stored partial results, after those of the given (year, month) pairs, or of all, are made anew.

    Each silver table of facts is scanned once, and only its partitions of these
    months. A run that is repeated replaces the same partitions.
    """
    for facts, make in (("flights", states.flight_states), ("cancelled", states.failure_states)):
        silver = read_silver(spark, base, facts)
        if months is not None:
            silver = silver.filter(reduce(lambda a, b: a | b, [(F.col("flight_year") == y) & (F.col("flight_month") == m) for y, m in months]))
        states.store(make(silver), f"{base}/state/{facts}")
    made = [states.stored(spark, f"{base}/state/{facts}") for facts in ("flights", "cancelled")]
    dimensions = [read_silver(spark, base, name) for name in ("weather", "airports")]
    for name in GOLD:
        replace_table(states.gold_table(name, *made, *dimensions), table_path(f"{base}/gold", name), GOLD_PARTITIONS[name])


def export_flights(
    spark: SparkSession, base: str, url: str, properties: Mapping[str, str], table: str = "silver_flights"
) -> None:
    """Copy the silver flights to a database table."""
    write_jdbc(read_silver(spark, base, "flights"), url, table, properties)


def build_all(spark: SparkSession, raw: str, base: str) -> DataFrame:
    """Write every table; returns the name, row count and column count of each.

    The row counts come from the footers of the written files.
    """
    for name in RAW_FILES:
        build_bronze(spark, name, raw, base)
    for name in SILVER:
        build_silver(spark, name, base)
    for name in GOLD:
        build_gold(spark, name, base)
    layers = {"bronze": RAW_FILES, "silver": SILVER, "gold": GOLD}
    return audit(
        {
            f"{layer}_{name}": read_table(spark, table_path(f"{base}/{layer}", name))
            for layer, names in layers.items()
            for name in names
        }
    )
