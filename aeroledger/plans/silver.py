"""Cleaned tables. Each is the exact-copy removal followed by a row-wise cleaning.

Copies are removed before any text is trimmed, so rows that differ in outer
blanks stay apart. The cleaning is one projection after the optimizer has
merged the steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aeroledger.functions import dates, delays, labels, measures
from aeroledger.functions import fixed_values as fixed
from aeroledger.operators import shaping
from aeroledger.operators.rows import drop_copies


def _finish(df: DataFrame, table: str) -> DataFrame:
    stamped = shaping.lower_columns(shaping.add_load_ts(df))
    return shaping.conform(stamped, StructType.fromDDL(fixed.SILVER_SCHEMAS[table]).names)


def clean_flights(df: DataFrame) -> DataFrame:
    """Row-wise cleaning of completed flights."""
    df = shaping.rename(df, fixed.FLIGHT_NAMES)
    df = shaping.trim_strings(df)
    df = shaping.upper_cols(df, ["Dep_Airport", "Arr_Airport", "Manufacturer"])
    df = df.withColumns(
        {
            "FlightDate": dates.parse_date("FlightDate", fixed.FLIGHT_DATE_FORMAT),
            "Distance_type": labels.map_labels("Distance_type", fixed.SHORT_DISTANCE_LABELS),
            "Dep_Delay_Type": labels.fix_label("Dep_Delay_Type"),
            "Arr_Delay_Type": labels.fix_label("Arr_Delay_Type"),
            "Departure_Status": labels.delay_status("Dep_Delay"),
            "Arrival_Status": labels.delay_status("Arr_Delay"),
            "Total_Delay_Minutes": delays.sum_or_null(fixed.DELAY_CAUSES.values()),
        }
    )
    df = df.withColumns(
        {
            **dates.date_parts("FlightDate", "Flight"),
            "Weekday_Name": dates.weekday_name("FlightDate"),
            "Primary_Delay_Cause": delays.argmax_label(fixed.DELAY_CAUSES, "Total_Delay_Minutes"),
        }
    )
    return _finish(df, "flights")


def clean_cancelled(df: DataFrame, distance_standard: str = "long") -> DataFrame:
    """Row-wise cleaning of cancelled and diverted flights.

    Distance labels become the long ones by default, while completed flights
    carry the short ones; ``distance_standard="short"`` keeps the two tables alike.
    """
    if distance_standard not in ("long", "short"):
        raise ValueError(f"distance_standard must be 'long' or 'short', not {distance_standard!r}")
    to_long = distance_standard == "long"
    distances = fixed.LONG_DISTANCE_LABELS if to_long else fixed.SHORT_DISTANCE_LABELS
    never_left = "Cancelled = 1"

    df = shaping.trim_strings(df)
    df = shaping.upper_cols(df, ["Dep_Airport", "Arr_Airport"])
    df = df.withColumns(
        {
            "Distance_type": labels.map_labels("Distance_type", distances),
            "Dep_Delay_Type": labels.fix_label("Dep_Delay_Type"),
            "Arr_Delay_Type": labels.fix_label("Arr_Delay_Type"),
            "Flight_Status": labels.flight_status("Cancelled", "Diverted"),
            **dates.date_parts("FlightDate", "Flight"),
            "Weekday_Name": labels.weekday_from_int("Day_Of_Week"),
        }
    )
    # The blanks have to come before the totals and causes that read them.
    df = shaping.nullify(df, fixed.BLANK_WHEN_CANCELLED, F.expr(never_left))
    df = df.withColumn("Total_Delay_Minutes", delays.sum_unless(fixed.DELAY_CAUSES.values(), never_left))
    cause = delays.argmax_label(fixed.DELAY_CAUSES, "Total_Delay_Minutes", blank_when=never_left)
    return _finish(df.withColumn("Primary_Delay_Cause", cause), "cancelled")


def clean_weather(df: DataFrame) -> DataFrame:
    """Row-wise cleaning of daily weather. Airport codes are not trimmed here."""
    df = shaping.rename(df, fixed.WEATHER_NAMES)
    df = shaping.fill(df, {"Snowfall_mm": 0.0})
    df = shaping.upper_cols(df, ["IATA_CODE"])
    df = df.withColumns(
        {
            **dates.date_parts("Weather_Date", "Weather"),
            "Temp_Range_C": measures.temp_range("Temp_Min_C", "Temp_Max_C"),
            "Is_Precipitation": measures.positive_flag("Precipitation_mm"),
            "Wind_Category": labels.bucket("Wind_Speed_kmh", fixed.WIND_STEPS, fixed.WIND_ABOVE),
            "Pressure_Category": labels.bucket("Pressure_hPa", fixed.PRESSURE_STEPS, fixed.PRESSURE_ABOVE),
        }
    )
    return _finish(df.withColumn("Weather_Season", labels.season("Weather_Month")), "weather")


def clean_airports(df: DataFrame) -> DataFrame:
    """Row-wise cleaning of the airport reference."""
    df = shaping.rename(df, fixed.AIRPORT_NAMES)
    df = shaping.trim_strings(df, exclude=["IATA_CODE"])
    df = df.withColumns(
        {
            "IATA_CODE": labels.normalize_key("IATA_CODE"),
            "Latitude": F.round("Latitude", 5),
            "Longitude": F.round("Longitude", 5),
            "US_Region": labels.group_of("State", fixed.REGION_STATES),
            "Is_Alaska_Hawaii": labels.is_in("State", fixed.ALASKA_HAWAII),
        }
    )
    return _finish(df, "airports")


def silver_flights(raw: DataFrame) -> DataFrame:
    """Completed flights, 33 columns."""
    return clean_flights(drop_copies(raw))


def silver_cancelled(raw: DataFrame, distance_standard: str = "long") -> DataFrame:
    """Cancelled and diverted flights, 31 columns."""
    return clean_cancelled(drop_copies(raw), distance_standard)


def silver_weather(raw: DataFrame) -> DataFrame:
    """Daily weather per airport, 19 columns."""
    return clean_weather(drop_copies(raw))


def silver_airports(raw: DataFrame) -> DataFrame:
    """Airport reference, 10 columns."""
    return clean_airports(drop_copies(raw))


def raw_day(table: str) -> Column:
    """Day of a raw row, by which the months of its silver table are in order."""
    if table == "flights":
        return F.try_to_date(F.trim("FlightDate"), fixed.FLIGHT_DATE_FORMAT)
    return F.col({"cancelled": "FlightDate", "weather": "time"}[table])


CLEANING = {
    "flights": clean_flights,
    "cancelled": clean_cancelled,
    "weather": clean_weather,
    "airports": clean_airports,
}
SILVER = {
    "flights": silver_flights,
    "cancelled": silver_cancelled,
    "weather": silver_weather,
    "airports": silver_airports,
}
