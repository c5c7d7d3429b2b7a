"""Stored partial results of the facts, from which all gold tables are made.

The measures of a summary are made of sums, counts and maxima per fact key (see
``operators.summarize``), so partial results of different months only have to be
put together. One scan of the flights gives those of the three tables that read
flights, one scan of the failed flights those of the other two and of the
operations summary: the facts are grouped by two sets of keys at once, routes
and days. The states are partitioned by month. A new or corrected month replaces
its own partition; older facts are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.functions.fixed_values import OPERATION_MONTHS
from aeroledger.operators.joins import with_airport
from aeroledger.operators.rows import in_months
from aeroledger.operators.summarize import Measure, combine
from aeroledger.plans import gold

MONTH = ["flight_year", "flight_month"]
ROUTE = [*gold.ROUTE_FACT_KEYS, "weekday_name"]
DAY = [*gold.DAY_KEYS, *MONTH]
KEYS = [*ROUTE, *[k for k in DAY if k not in ROUTE]]

# Gold table -> the keys by which it needs its facts, and its measures.
OF_FLIGHTS = {
    "flight_performance": ("route", gold.PERFORMANCE),
    "weather_delay_impact": ("day", gold.DELAY_IMPACT),
    "ops_summary": ("route", gold.OPERATIONS),
}
OF_FAILURES = {
    "cancellation_analysis": ("route", gold.CANCELLATIONS),
    "weather_cancellation": ("day", gold.WEATHER_CANCELLATIONS),
    "ops_summary": ("route", gold.OPERATIONS),
}


def _columns(tables: dict[str, tuple[str, list[Measure]]]) -> dict[str, str]:
    """Stored column of each partial result; tables share those that are computed alike."""
    stored: dict[str, str] = {}
    for _, measures in tables.values():
        for m in measures:
            for name, sql in m.partial.items():
                if sql not in stored:
                    stored[sql] = name if name not in stored.values() else f"{name}_{len(stored)}"
    return stored


def _reduce(facts: DataFrame, tables: dict[str, tuple[str, list[Measure]]]) -> DataFrame:
    sets = {"route": ROUTE, "day": DAY}
    names = F.coalesce(
        *[
            F.when(F.col("grouping") == sum((k not in keys) << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS)), name)
            for name, keys in sets.items()
        ]
    )
    partial = [F.expr(f"{sql} AS {name}") for sql, name in _columns(tables).items()]
    grouped = facts.groupingSets([[F.col(k) for k in keys] for keys in sets.values()], *[F.col(k) for k in KEYS])
    reduced = grouped.agg(F.grouping_id().alias("grouping"), *partial)
    return reduced.select(names.alias("grain"), *KEYS, *_columns(tables).values())


def flight_states(flights: DataFrame) -> DataFrame:
    """Partial results of completed flights."""
    return _reduce(flights.withColumn("flight_status", F.lit("Completed")), OF_FLIGHTS)


def failure_states(cancelled: DataFrame) -> DataFrame:
    """Partial results of cancelled and diverted flights."""
    return _reduce(cancelled, OF_FAILURES)


def _rows_for(states: DataFrame, tables: dict[str, tuple[str, list[Measure]]], table: str) -> DataFrame:
    """The partial rows of one gold table, under the names of its measures."""
    grain, measures = tables[table]
    stored = _columns(tables)
    partial = {name: stored[sql] for m in measures for name, sql in m.partial.items()}
    keys = ROUTE if grain == "route" else DAY
    return states.filter(F.col("grain") == grain).select(*keys, *[F.col(c).alias(n) for n, c in partial.items()])


def gold_table(
    name: str,
    flights: DataFrame,
    failures: DataFrame,
    weather: DataFrame,
    airports: DataFrame,
    months: Sequence[int] = OPERATION_MONTHS,
) -> DataFrame:
    """A gold table from the states of all its months; the same rows as from the facts."""
    if name == "ops_summary":
        failed = in_months(_rows_for(failures, OF_FAILURES, name), months)
        rows = _rows_for(flights, OF_FLIGHTS, name).unionByName(failed)
    else:
        rows = _rows_for(flights, OF_FLIGHTS, name) if name in OF_FLIGHTS else _rows_for(failures, OF_FAILURES, name)
    grain, measures = (OF_FLIGHTS | OF_FAILURES)[name]
    if grain == "day":
        keys = gold.SKY_KEYS if name == "weather_delay_impact" else [*gold.SKY_KEYS, "flight_month"]
        return combine(gold.with_sky(weather, airports)(rows), keys, measures)
    keys = gold.ROUTE_KEYS if name == "flight_performance" else [*gold.ROUTE_KEYS, "weekday_name"]
    return combine(with_airport(rows, airports), keys, measures)


def scope(flights: DataFrame, failures: DataFrame, months: Sequence[int] = OPERATION_MONTHS) -> dict[str, DataFrame]:
    """Number of facts (column row_count) of the tables that the operations summary puts together."""

    def facts(states: DataFrame, tables: dict[str, tuple[str, list[Measure]]]) -> DataFrame:
        return _rows_for(states, tables, "ops_summary").select("flight_month", F.col("total_scheduled").alias("n"))

    completed, failed = facts(flights, OF_FLIGHTS), facts(failures, OF_FAILURES)
    parts = {
        "flights": completed,
        "cancelled_all": failed,
        "cancelled_window": in_months(failed, months),
        "union": completed.unionByName(in_months(failed, months)),
    }
    return {name: df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")) for name, df in parts.items()}


def store(states: DataFrame, path: str) -> None:
    """Write states; the months that they hold replace what is stored of them, the others stay."""
    rows = states.hint("rebalance", *[F.col(c) for c in MONTH])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*MONTH).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    states = spark.read.parquet(path)
    return states.withColumns({c: F.col(c).cast("int") for c in MONTH})
