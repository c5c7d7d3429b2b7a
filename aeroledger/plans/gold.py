"""Summary tables.

Each reduces the facts by their own keys before it joins a dimension; see
``operators.summarize``. A summary over the facts therefore costs one shuffle
of partial results, and the joins run on the reduced rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from aeroledger.functions.fixed_values import OPERATION_MONTHS
from aeroledger.operators.joins import with_airport, with_weather
from aeroledger.operators.profiling import join_coverage
from aeroledger.operators.rows import union_operations
from aeroledger.operators.summarize import (
    Measure,
    added,
    added_over,
    averaged,
    averaged_over,
    counted,
    largest,
    reduce_facts,
    summarize,
)

ROUTE_FACT_KEYS = [
    "flight_year", "flight_month", "airline", "dep_airport", "arr_airport", "arr_cityname", "distance_type",
]
ROUTE_KEYS = [
    "flight_year", "flight_month", "airline",
    "dep_airport", "dep_city", "dep_state", "dep_region",
    "arr_airport", "arr_cityname", "distance_type",
]
SKY_KEYS = ["weather_season", "wind_category", "pressure_category", "is_precipitation", "dep_region"]
DAY_KEYS = ["dep_airport", "flightdate"]

# Flags are 1 or 0, and NULL where the tested column is NULL.
DELAYED = "int(dep_delay > 0)"
ON_TIME = "int(dep_delay <= 0)"
CANCELLED = "int(cancelled = 1)"
DIVERTED = "int(diverted = 1)"
DIVERTED_DELAY = "CASE WHEN diverted = 1 THEN dep_delay END"
# A weather record without a wind reading counts as no match.
HAS_WEATHER = "int(wind_category IS NOT NULL)"


def _cause(label: str) -> str:
    return f"int(primary_delay_cause = '{label}')"


def _status(label: str) -> str:
    return f"int(flight_status = '{label}')"


def _share(name: str, flag: str, digits: int) -> Measure:
    return averaged(name, flag, digits, percent=True)


def _match_measures(name: str, facts: str) -> list[Measure]:
    """Facts that met a weather record, and their share."""
    return [
        added_over(name, HAS_WEATHER, facts),
        averaged_over("weather_match_pct", HAS_WEATHER, facts, 1, percent=True),
    ]


def _sky_measures(facts: str) -> list[Measure]:
    """Means over facts of the weather they met."""
    return [
        averaged_over("avg_temp_c", "temp_avg_c", facts, 1),
        averaged_over("avg_temp_range_c", "temp_range_c", facts, 1),
        averaged_over("avg_wind_speed_kmh", "wind_speed_kmh", facts, 1),
        averaged_over("avg_precipitation_mm", "precipitation_mm", facts, 2),
        averaged_over("avg_snowfall_mm", "snowfall_mm", facts, 2),
    ]


PERFORMANCE = [
    counted("total_flights"),
    averaged("avg_dep_delay_min", "dep_delay", 1),
    averaged("avg_arr_delay_min", "arr_delay", 1),
    largest("max_dep_delay_min", "dep_delay"),
    averaged("avg_flight_duration_min", "flight_duration", 1),
    averaged("avg_total_delay_min", "total_delay_minutes", 1),
    _share("on_time_pct", ON_TIME, 1),
    _share("delayed_pct", DELAYED, 1),
    _share("carrier_delay_pct", _cause("Carrier"), 1),
    _share("weather_delay_pct", _cause("Weather"), 1),
    _share("nas_delay_pct", _cause("NAS"), 1),
    _share("aircraft_delay_pct", _cause("LastAircraft"), 1),
]
DELAY_IMPACT = [
    counted("total_flights"),
    *_match_measures("flights_with_weather", "total_flights"),
    averaged("avg_dep_delay_min", "dep_delay", 1),
    averaged("avg_arr_delay_min", "arr_delay", 1),
    _share("delayed_flight_pct", DELAYED, 1),
    averaged("avg_total_delay_min", "total_delay_minutes", 1),
    *_sky_measures("total_flights"),
]
CANCELLATIONS = [
    counted("total_events"),
    added("cancelled_count", CANCELLED),
    added("diverted_count", DIVERTED),
    _share("cancellation_rate_pct", CANCELLED, 2),
    _share("diversion_rate_pct", DIVERTED, 2),
    averaged("diverted_avg_dep_delay_min", DIVERTED_DELAY, 1),
    largest("diverted_max_dep_delay_min", DIVERTED_DELAY),
]
WEATHER_CANCELLATIONS = [
    counted("total_events"),
    *_match_measures("events_with_weather", "total_events"),
    added("cancelled_count", CANCELLED),
    added("diverted_count", DIVERTED),
    _share("cancellation_rate_pct", CANCELLED, 2),
    _share("diversion_rate_pct", DIVERTED, 2),
    *_sky_measures("total_events"),
]
OPERATIONS = [
    counted("total_scheduled"),
    added("completed_count", _status("Completed")),
    added("cancelled_count", _status("Cancelled")),
    added("diverted_count", _status("Diverted")),
    _share("completion_rate_pct", _status("Completed"), 2),
    _share("cancellation_rate_pct", _status("Cancelled"), 2),
    _share("diversion_rate_pct", _status("Diverted"), 2),
    averaged("avg_dep_delay_min", "dep_delay", 1),
    averaged("avg_arr_delay_min", "arr_delay", 1),
    averaged("avg_flight_duration_min", "flight_duration", 1),
    _share("on_time_pct", ON_TIME, 1),
    _share("delayed_pct", DELAYED, 1),
]


def with_sky(weather: DataFrame, airports: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Joins of the weather and region of a departure."""
    return lambda df: with_airport(with_weather(df, weather), airports, columns=["us_region"])


def flight_performance(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Completed flights per airline, route, month and distance; 22 columns."""
    return summarize(flights, ROUTE_FACT_KEYS, lambda df: with_airport(df, airports), ROUTE_KEYS, PERFORMANCE)


def weather_delay_impact(flights: DataFrame, weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Completed flights per kind of weather and region; 17 columns."""
    return summarize(flights, DAY_KEYS, with_sky(weather, airports), SKY_KEYS, DELAY_IMPACT)


def cancellation_analysis(cancelled: DataFrame, airports: DataFrame) -> DataFrame:
    """Failed flights per airline, route, month, distance and weekday; 18 columns.

    The rates are shares of failed flights only; ``ops_summary`` has the shares
    of all scheduled flights.
    """
    return summarize(
        cancelled,
        [*ROUTE_FACT_KEYS, "weekday_name"],
        lambda df: with_airport(df, airports),
        [*ROUTE_KEYS, "weekday_name"],
        CANCELLATIONS,
    )


def weather_cancellation(cancelled: DataFrame, weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Failed flights per kind of weather, region and month; 18 columns."""
    return summarize(
        cancelled,
        [*DAY_KEYS, "flight_month"],
        with_sky(weather, airports),
        [*SKY_KEYS, "flight_month"],
        WEATHER_CANCELLATIONS,
    )


def ops_summary(
    flights: DataFrame,
    cancelled: DataFrame,
    airports: DataFrame,
    months: Sequence[int] = OPERATION_MONTHS,
) -> DataFrame:
    """All scheduled flights of a span of months per airline, route and weekday; 23 columns."""
    return summarize(
        union_operations(flights, cancelled, months),
        [*ROUTE_FACT_KEYS, "weekday_name"],
        lambda df: with_airport(df, airports),
        [*ROUTE_KEYS, "weekday_name"],
        OPERATIONS,
    )


def weather_coverage(
    facts: DataFrame, weather: DataFrame, airports: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Facts that met a weather record, in all or per ``by`` column."""
    daily = reduce_facts(facts, [*DAY_KEYS, *by], [counted("facts")])
    return join_coverage(with_sky(weather, airports)(daily), "wind_category", by, facts="facts")
