"""Left joins that enrich a fact table.

No join here forces a broadcast. Spark compares the size of the dimension,
from file statistics or, at run time, from the finished shuffle, with
``spark.sql.autoBroadcastJoinThreshold``: a dimension below it is broadcast, a
larger one is sort-merge joined, where adaptive execution splits the partitions
of hot and NULL keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.fixed_values import WEATHER_FACTS

AIRPORT_FACTS = {"city": "city", "state": "state", "us_region": "region"}


def airport_dim(airports: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    """Airport columns under role names, e.g. ``us_region`` as ``dep_region``."""
    return airports.select(
        F.col("iata_code").alias(f"_{prefix}_iata"),
        *[F.col(c).alias(f"{prefix}_{AIRPORT_FACTS[c]}") for c in columns],
    )


def with_airport(
    df: DataFrame,
    airports: DataFrame,
    on: str = "dep_airport",
    prefix: str = "dep",
    columns: Sequence[str] = tuple(AIRPORT_FACTS),
) -> DataFrame:
    """Add airport columns; facts without an airport keep NULLs there."""
    key = f"_{prefix}_iata"
    dim = airport_dim(airports, prefix, columns)
    return df.join(dim, F.col(on) == F.col(key), "left").drop(key)


def with_weather(
    df: DataFrame,
    weather: DataFrame,
    airport: str = "dep_airport",
    date: str = "flightdate",
    columns: Sequence[str] = tuple(WEATHER_FACTS),
) -> DataFrame:
    """Add the weather of an airport and day; facts without a record keep NULLs there."""
    slim = weather.select(
        F.col("iata_code").alias("_wx_iata"), F.col("weather_date").alias("_wx_date"), *columns
    )
    match = (F.col(airport) == F.col("_wx_iata")) & (F.col(date) == F.col("_wx_date"))
    return df.join(slim, match, "left").drop("_wx_iata", "_wx_date")
