"""Ranked and grouped reports.

Reports over silver tables count values. Reports over gold tables add up counts
and average the group percentages, one vote per group; ``weighted=True``
weights each group by its number of flights instead. Rankings break ties by the
key columns, so a limit always keeps the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.fixed_values import WORST_ROUTE_MIN_SCHEDULED
from aeroledger.functions.measures import exact_mean
from aeroledger.operators.rows import frequency


@dataclass(frozen=True)
class Report:
    """A report over a gold table, by one key."""

    gold: str
    key: str
    totals: Mapping[str, str]  # output -> summed column
    means: Mapping[str, tuple[str, int]]  # output -> (averaged column, decimals)
    rank_by: str | None = None  # None: in key order
    ascending: bool = False


# The column that counts the flights of a group, per gold table.
GROUP_SIZE = {
    "flight_performance": "total_flights",
    "weather_delay_impact": "total_flights",
    "cancellation_analysis": "total_events",
    "weather_cancellation": "total_events",
    "ops_summary": "total_scheduled",
}

_EVENTS = {"total_events": "total_events"}
_EVENTS_CANCELLED = {**_EVENTS, "cancelled": "cancelled_count"}
_FLIGHTS = {"total_flights": "total_flights"}
_SCHEDULED = {"total_scheduled": "total_scheduled"}
_SCHEDULED_CANCELLED = {**_SCHEDULED, "cancelled": "cancelled_count"}
_CANCEL_RATE = {"cancel_rate_pct": ("cancellation_rate_pct", 2)}
_COMPLETION_RATE = {"completion_rate_pct": ("completion_rate_pct", 2)}
_ON_TIME = {"on_time_pct": ("on_time_pct", 1)}
_WEATHER_DELAY = {"avg_dep_delay": ("avg_dep_delay_min", 1), "delayed_pct": ("delayed_flight_pct", 1)}

GOLD_REPORTS = {
    "ontime_by_airline": Report(
        "flight_performance", "airline", {}, {"avg_on_time_pct": ("on_time_pct", 1)},
        rank_by="avg_on_time_pct",
    ),
    "perf_by_region": Report(
        "flight_performance", "dep_region", _FLIGHTS,
        {"avg_dep_delay": ("avg_dep_delay_min", 1), **_ON_TIME},
    ),
    "delay_by_wind": Report("weather_delay_impact", "wind_category", _FLIGHTS, _WEATHER_DELAY),
    "delay_by_pressure": Report("weather_delay_impact", "pressure_category", {}, _WEATHER_DELAY),
    "delay_by_precip": Report("weather_delay_impact", "is_precipitation", _FLIGHTS, _WEATHER_DELAY),
    "cancel_by_airline": Report(
        "cancellation_analysis", "airline", _EVENTS_CANCELLED,
        {"avg_cancel_rate_pct": ("cancellation_rate_pct", 2)},
        rank_by="avg_cancel_rate_pct",
    ),
    "cancel_by_month": Report(
        "cancellation_analysis", "flight_month", _EVENTS_CANCELLED, _CANCEL_RATE
    ),
    "cancel_by_region": Report(
        "cancellation_analysis", "dep_region", _EVENTS, _CANCEL_RATE, rank_by="cancel_rate_pct"
    ),
    "cancel_by_weekday": Report(
        "cancellation_analysis", "weekday_name", _EVENTS, _CANCEL_RATE, rank_by="cancel_rate_pct"
    ),
    "ops_by_airline": Report(
        "ops_summary", "airline",
        {**_SCHEDULED, "completed": "completed_count", "cancelled": "cancelled_count"},
        {**_CANCEL_RATE, **_COMPLETION_RATE},
        rank_by="cancel_rate_pct", ascending=True,
    ),
    "ops_by_month": Report(
        "ops_summary", "flight_month", _SCHEDULED_CANCELLED, {**_CANCEL_RATE, **_COMPLETION_RATE}
    ),
    "ops_by_region": Report(
        "ops_summary", "dep_region", _SCHEDULED_CANCELLED, {**_CANCEL_RATE, **_ON_TIME},
        rank_by="cancel_rate_pct",
    ),
    "ops_by_weekday": Report(
        "ops_summary", "weekday_name", _SCHEDULED,
        {**_CANCEL_RATE, **_ON_TIME, "avg_dep_delay_min": ("avg_dep_delay_min", 1)},
        rank_by="cancel_rate_pct",
    ),
    "wx_cancel_by_wind": Report(
        "weather_cancellation", "wind_category", _EVENTS_CANCELLED,
        {**_CANCEL_RATE, "avg_wind_kmh": ("avg_wind_speed_kmh", 1)},
        rank_by="cancel_rate_pct",
    ),
    "wx_cancel_by_pressure": Report(
        "weather_cancellation", "pressure_category", _EVENTS, _CANCEL_RATE, rank_by="cancel_rate_pct"
    ),
    "wx_cancel_by_precip": Report(
        "weather_cancellation", "is_precipitation", _EVENTS,
        {**_CANCEL_RATE, "avg_precip_mm": ("avg_precipitation_mm", 2)},
    ),
    "wx_cancel_by_season": Report(
        "weather_cancellation", "weather_season", _EVENTS_CANCELLED,
        {**_CANCEL_RATE, "avg_snowfall_mm": ("avg_snowfall_mm", 2)},
        rank_by="cancel_rate_pct",
    ),
    "wx_cancel_by_region": Report(
        "weather_cancellation", "dep_region", _EVENTS, _CANCEL_RATE, rank_by="cancel_rate_pct"
    ),
}


def ranked(
    df: DataFrame, metric: str, keys: Sequence[str], limit: int | None = None, ascending: bool = False
) -> DataFrame:
    """Rows by a metric, the best first unless ascending, ties by the keys."""
    lead = F.col(metric).asc_nulls_first() if ascending else F.col(metric).desc_nulls_last()
    ordered = df.orderBy(lead, *[F.col(k).asc_nulls_first() for k in keys])
    return ordered if limit is None else ordered.limit(limit)


def gold_report(gold: DataFrame, name: str, weighted: bool = False, limit: int | None = None) -> DataFrame:
    """One of ``GOLD_REPORTS`` over its gold table: every group, or the first ``limit``."""
    spec = GOLD_REPORTS[name]
    weight = GROUP_SIZE[spec.gold] if weighted else None
    out = gold.groupBy(spec.key).agg(
        *[F.sum(c).alias(n) for n, c in spec.totals.items()],
        *[exact_mean(c, digits, weight).alias(n) for n, (c, digits) in spec.means.items()],
    )
    if spec.rank_by:
        return ranked(out, spec.rank_by, [spec.key], limit, spec.ascending)
    out = out.orderBy(F.col(spec.key).asc_nulls_first())
    return out if limit is None else out.limit(limit)


def top_routes(performance: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """Rows of the flight performance table with the longest mean departure delay."""
    return ranked(performance, "avg_dep_delay_min", keys, n)


def worst_routes(
    summary: DataFrame, keys: Sequence[str], min_scheduled: int = WORST_ROUTE_MIN_SCHEDULED, n: int = 10
) -> DataFrame:
    """Groups of the operations summary that are large enough, by cancellation rate."""
    large = summary.filter(F.col("total_scheduled") >= min_scheduled)
    return ranked(large, "cancellation_rate_pct", keys, n).select(
        "dep_airport", "arr_airport", "airline",
        "total_scheduled", "cancelled_count", "cancellation_rate_pct", "avg_dep_delay_min",
    )


def diverted_causes(cancelled: DataFrame) -> DataFrame:
    """Delay causes of diverted flights, the most frequent first."""
    return frequency(cancelled.filter(F.col("diverted") == 1), "primary_delay_cause", by_count=True)


def delay_nulls_by_status(cancelled: DataFrame) -> DataFrame:
    """Missing and present departure delays per flight status."""
    missing = F.col("dep_delay").isNull()
    return (
        cancelled.groupBy("flight_status")
        .agg(
            F.count_if(missing).alias("dep_delay_nulls"),
            F.count_if(~missing).alias("dep_delay_values"),
        )
        .orderBy(F.col("flight_status").asc_nulls_first())
    )


def status_split(operations: DataFrame) -> DataFrame:
    """Scheduled flights per status."""
    return frequency(operations, "flight_status")
