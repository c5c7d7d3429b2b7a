"""DuckDB SQL that states the result of each registered query on its own terms.

The SQL joins first and aggregates afterwards, over the full rows, so it does
not share the plan of the Spark queries. Doubles are rounded on their shortest
decimal form, half up, as Spark does; DuckDB's own ``round`` on doubles is not.
"""

from __future__ import annotations

import re

from harness.fixtures import DUCKDB, raw_sql
from harness.queries import GOLD_REPORT_QUERIES, WORST_ROUTE_MIN_SCHEDULED


def dround(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(30,17)), {digits}) AS DOUBLE)"


def mean(expr: str, digits: int) -> str:
    return dround(f"avg({expr})", digits)


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 WHEN NOT ({condition}) THEN 0 END"


def rate(condition: str, digits: int) -> str:
    return dround(f"avg({flag(condition)})*100", digits)


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def exact_mean(col: str, digits: int) -> str:
    return dround(f"CAST(sum(CAST({col} AS DECIMAL(18,4))) AS DOUBLE)/count({col})", digits)


# Spelled out here on purpose: the check must not share the tables it checks.
BLANK_WHEN_CANCELLED = (
    "Dep_Delay Dep_Delay_Tag Dep_Delay_Type Arr_Delay Arr_Delay_Type Delay_Carrier Delay_Weather Delay_NAS "
    "Delay_Security Delay_LastAircraft Flight_Duration"
).split()
CAUSE_COLUMNS = ["Delay_Carrier", "Delay_Weather", "Delay_NAS", "Delay_Security", "Delay_LastAircraft"]
OPERATION_COLUMNS = [
    "flightdate", "flight_year", "flight_month", "flight_day", "day_of_week", "weekday_name", "airline",
    "tail_number", "dep_airport", "dep_cityname", "arr_airport", "arr_cityname", "deptime_label",
    "distance_type", "dep_delay", "arr_delay", "flight_duration",
]
REGIONS = """CASE WHEN {0} IN ('CT','ME','MA','NH','RI','VT','NY','NJ','PA') THEN 'Northeast'
  WHEN {0} IN ('DE','MD','VA','WV','NC','SC','GA','FL','AL','MS','TN','KY','AR','LA') THEN 'Southeast'
  WHEN {0} IN ('OH','MI','IN','WI','IL','MN','IA','MO','ND','SD','NE','KS') THEN 'Midwest'
  WHEN {0} IN ('TX','OK','NM','AZ') THEN 'Southwest'
  WHEN {0} IN ('CO','WY','MT','ID','WA','OR','CA','NV','UT') THEN 'West'
  WHEN {0} IN ('AK','HI') THEN 'Pacific' END"""

# --- tables -------------------------------------------------------------------------

BLANKED = {c: f"CASE WHEN Cancelled = 1 THEN NULL ELSE {c} END" for c in BLANK_WHEN_CANCELLED}
C, W, N, S, L = CAUSE_COLUMNS
SUM_OF_CAUSES = "CAST(" + "+".join(f"coalesce({c},0)" for c in CAUSE_COLUMNS) + " AS INTEGER)"
ALL_CAUSES_NULL = " AND ".join(f"{c} IS NULL" for c in CAUSE_COLUMNS)


def cause(blank: str, total_col: str, wrap: str = "{}") -> str:
    c, w, n, s, last = (wrap.format(x) for x in (C, W, N, S, L))
    return f"""CASE WHEN {blank} THEN NULL WHEN {total_col} = 0 THEN 'None'
      WHEN {c}>={w} AND {c}>={n} AND {c}>={s} AND {c}>={last} THEN 'Carrier'
      WHEN {w}>={n} AND {w}>={s} AND {w}>={last} THEN 'Weather'
      WHEN {n}>={s} AND {n}>={last} THEN 'NAS'
      WHEN {s}>={last} THEN 'Security' ELSE 'LastAircraft' END"""


def status(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN NULL WHEN {col}<0 THEN 'Early' WHEN {col}=0 THEN 'On Time' ELSE 'Delayed' END"


def part(name: str, col: str) -> str:
    return f"CAST({name}({col}) AS INTEGER)"


def fixed_label(col: str) -> str:
    return f"regexp_replace({col}, 'Hight', 'High', 'gi')"


def region(col: str) -> str:
    return REGIONS.format(col)


WEEKDAY_FROM_INT = """CASE Day_Of_Week WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
  WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' WHEN 7 THEN 'Sunday' END"""
FLIGHT_STATUS = "CASE WHEN Cancelled=1 THEN 'Cancelled' WHEN Diverted=1 THEN 'Diverted' ELSE 'Completed' END"
SHORT_LABEL = """CASE {0} WHEN 'Short Haul >1500Mi' THEN 'Short Haul' WHEN 'Medium Haul <3000Mi' THEN 'Medium Haul'
  WHEN 'Long Haul <6000Mi' THEN 'Long Haul' ELSE {0} END"""
LONG_LABEL = """CASE {0} WHEN 'Short Haul' THEN 'Short Haul >1500Mi' WHEN 'Medium Haul' THEN 'Medium Haul <3000Mi'
  WHEN 'Long Haul' THEN 'Long Haul <6000Mi' ELSE {0} END"""
WIND = """CASE WHEN {0} IS NULL THEN NULL WHEN {0}=0 THEN 'Calm' WHEN {0}<=20 THEN 'Light' WHEN {0}<=40 THEN 'Moderate'
  WHEN {0}<=60 THEN 'Strong' ELSE 'Severe' END"""
PRESSURE = "CASE WHEN {0} IS NULL THEN NULL WHEN {0}<1000 THEN 'Low' WHEN {0}<=1020 THEN 'Normal' ELSE 'High' END"
SEASON = """CASE WHEN {0} IN (12,1,2) THEN 'Winter' WHEN {0} IN (3,4,5) THEN 'Spring' WHEN {0} IN (6,7,8) THEN 'Summer'
  WHEN {0} IN (9,10,11) THEN 'Fall' END"""
PARSED = "CAST(try_strptime(FlightDate, '%d-%m-%Y') AS DATE)"


def _silver_cancelled(distance: str) -> str:
    blanked = ", ".join(f"{value} AS {c}" for c, value in BLANKED.items())
    others = ", ".join(BLANK_WHEN_CANCELLED)
    return f"""
SELECT FlightDate AS flightdate, {part('year', 'FlightDate')} AS flight_year, {part('month', 'FlightDate')} AS flight_month,
  {part('day', 'FlightDate')} AS flight_day, Day_Of_Week AS day_of_week, {WEEKDAY_FROM_INT} AS weekday_name,
  trim(Airline) AS airline, trim(Tail_Number) AS tail_number, Cancelled AS cancelled, Diverted AS diverted,
  {FLIGHT_STATUS} AS flight_status, upper(trim(Dep_Airport)) AS dep_airport, trim(Dep_CityName) AS dep_cityname,
  upper(trim(Arr_Airport)) AS arr_airport, trim(Arr_CityName) AS arr_cityname, trim(DepTime_label) AS deptime_label,
  Flight_Duration AS flight_duration, {distance.format('trim(Distance_type)')} AS distance_type,
  Dep_Delay AS dep_delay, Dep_Delay_Tag AS dep_delay_tag, {fixed_label('trim(Dep_Delay_Type)')} AS dep_delay_type,
  Arr_Delay AS arr_delay, {fixed_label('trim(Arr_Delay_Type)')} AS arr_delay_type,
  Delay_Carrier AS delay_carrier, Delay_Weather AS delay_weather, Delay_NAS AS delay_nas, Delay_Security AS delay_security,
  Delay_LastAircraft AS delay_lastaircraft,
  CASE WHEN Cancelled=1 THEN NULL ELSE {SUM_OF_CAUSES} END AS total_delay_minutes,
  {cause('Cancelled=1', SUM_OF_CAUSES)} AS primary_delay_cause,
  TRUE AS load_timestamp_set
FROM (SELECT * EXCLUDE ({others}), {blanked} FROM (SELECT DISTINCT * FROM raw_cancelled))"""


DEP_AIRPORT = "LEFT JOIN silver_airports a ON f.dep_airport = a.iata_code"
WEATHER_JOIN = "LEFT JOIN silver_weather w ON f.dep_airport = w.iata_code AND f.flightdate = w.weather_date"
ROUTE = """f.flight_year, f.flight_month, f.airline, f.dep_airport, a.city AS dep_city, a.state AS dep_state,
  a.us_region AS dep_region, f.arr_airport, f.arr_cityname, f.distance_type"""
SKY = "w.weather_season, w.wind_category, w.pressure_category, w.is_precipitation, a.us_region AS dep_region"
HAS_WEATHER = "w.wind_category IS NOT NULL"
SKY_MEANS = f"""{exact_mean('w.temp_avg_c', 1)} AS avg_temp_c, {exact_mean('w.temp_range_c', 1)} AS avg_temp_range_c,
  {exact_mean('w.wind_speed_kmh', 1)} AS avg_wind_speed_kmh, {exact_mean('w.precipitation_mm', 2)} AS avg_precipitation_mm,
  {exact_mean('w.snowfall_mm', 2)} AS avg_snowfall_mm"""


def _ops_summary(operations: str) -> str:
    return f"""
SELECT {ROUTE}, f.weekday_name, count(*) AS total_scheduled,
  {total(flag("f.flight_status='Completed'"))} AS completed_count,
  {total(flag("f.flight_status='Cancelled'"))} AS cancelled_count,
  {total(flag("f.flight_status='Diverted'"))} AS diverted_count,
  {rate("f.flight_status='Completed'", 2)} AS completion_rate_pct,
  {rate("f.flight_status='Cancelled'", 2)} AS cancellation_rate_pct,
  {rate("f.flight_status='Diverted'", 2)} AS diversion_rate_pct,
  {mean('f.dep_delay', 1)} AS avg_dep_delay_min, {mean('f.arr_delay', 1)} AS avg_arr_delay_min,
  {mean('f.flight_duration', 1)} AS avg_flight_duration_min,
  {rate('f.dep_delay<=0', 1)} AS on_time_pct, {rate('f.dep_delay>0', 1)} AS delayed_pct
FROM {operations} f {DEP_AIRPORT} GROUP BY ALL"""


def _operations(cancelled: str) -> str:
    cols = ", ".join(OPERATION_COLUMNS)
    return f"""
SELECT {cols}, 'Completed' AS flight_status FROM silver_flights
UNION ALL SELECT {cols}, flight_status FROM {cancelled} WHERE flight_month IN (1,2,3)"""


# Named subqueries; one may use those named before it.
TABLES: dict[str, str] = {
    **{f"raw_{n}": raw_sql(n, DUCKDB) for n in ("flights", "cancelled", "weather", "airports")},
    "silver_flights": f"""
SELECT {PARSED} AS flightdate, {part('year', PARSED)} AS flight_year, {part('month', PARSED)} AS flight_month,
  {part('day', PARSED)} AS flight_day, Day_Of_Week AS day_of_week, dayname({PARSED}) AS weekday_name,
  trim(Airline) AS airline, trim(Tail_Number) AS tail_number, upper(trim(Manufacturer)) AS manufacturer,
  trim(Model) AS model, Aicraft_age AS aircraft_age, upper(trim(Dep_Airport)) AS dep_airport,
  trim(Dep_CityName) AS dep_cityname, upper(trim(Arr_Airport)) AS arr_airport, trim(Arr_CityName) AS arr_cityname,
  trim(DepTime_label) AS deptime_label, Flight_Duration AS flight_duration,
  {SHORT_LABEL.format('trim(Distance_type)')} AS distance_type,
  Dep_Delay AS dep_delay, Dep_Delay_Tag AS dep_delay_tag, {fixed_label('trim(Dep_Delay_Type)')} AS dep_delay_type,
  {status('Dep_Delay')} AS departure_status, Arr_Delay AS arr_delay,
  {fixed_label('trim(Arr_Delay_Type)')} AS arr_delay_type, {status('Arr_Delay')} AS arrival_status,
  Delay_Carrier AS delay_carrier, Delay_Weather AS delay_weather, Delay_NAS AS delay_nas, Delay_Security AS delay_security,
  Delay_LastAircraft AS delay_lastaircraft,
  CASE WHEN {ALL_CAUSES_NULL} THEN NULL ELSE {SUM_OF_CAUSES} END AS total_delay_minutes,
  {cause(ALL_CAUSES_NULL, SUM_OF_CAUSES)} AS primary_delay_cause,
  TRUE AS load_timestamp_set
FROM (SELECT DISTINCT * FROM raw_flights)""",
    "silver_cancelled": _silver_cancelled(LONG_LABEL),
    "silver_cancelled_short": _silver_cancelled(SHORT_LABEL),
    "silver_weather": f"""
SELECT upper(airport_id) AS iata_code, time AS weather_date, {part('year', 'time')} AS weather_year,
  {part('month', 'time')} AS weather_month, {part('day', 'time')} AS weather_day,
  {SEASON.format('month(time)')} AS weather_season, tavg AS temp_avg_c, tmin AS temp_min_c, tmax AS temp_max_c,
  {dround('tmax - tmin', 1)} AS temp_range_c, prcp AS precipitation_mm,
  CASE WHEN prcp IS NULL THEN NULL ELSE prcp > 0 END AS is_precipitation, coalesce(snow, 0e0) AS snowfall_mm,
  wspd AS wind_speed_kmh, wdir AS wind_direction_deg, {WIND.format('wspd')} AS wind_category,
  pres AS pressure_hpa, {PRESSURE.format('pres')} AS pressure_category, TRUE AS load_timestamp_set
FROM (SELECT DISTINCT * FROM raw_weather)""",
    "silver_airports": f"""
SELECT upper(trim(IATA_CODE)) AS iata_code, trim(AIRPORT) AS airport_name, trim(CITY) AS city, trim(STATE) AS state,
  trim(COUNTRY) AS country, {dround('LATITUDE', 5)} AS latitude, {dround('LONGITUDE', 5)} AS longitude,
  {region('trim(STATE)')} AS us_region, coalesce(trim(STATE) IN ('AK','HI'), FALSE) AS is_alaska_hawaii,
  TRUE AS load_timestamp_set
FROM (SELECT DISTINCT * FROM raw_airports)""",
    "operations": _operations("silver_cancelled"),
    "operations_short": _operations("silver_cancelled_short"),
    "gold_flight_performance": f"""
SELECT {ROUTE}, count(*) AS total_flights, {mean('f.dep_delay', 1)} AS avg_dep_delay_min,
  {mean('f.arr_delay', 1)} AS avg_arr_delay_min, max(f.dep_delay) AS max_dep_delay_min,
  {mean('f.flight_duration', 1)} AS avg_flight_duration_min, {mean('f.total_delay_minutes', 1)} AS avg_total_delay_min,
  {rate('f.dep_delay<=0', 1)} AS on_time_pct, {rate('f.dep_delay>0', 1)} AS delayed_pct,
  {rate("f.primary_delay_cause='Carrier'", 1)} AS carrier_delay_pct,
  {rate("f.primary_delay_cause='Weather'", 1)} AS weather_delay_pct,
  {rate("f.primary_delay_cause='NAS'", 1)} AS nas_delay_pct,
  {rate("f.primary_delay_cause='LastAircraft'", 1)} AS aircraft_delay_pct
FROM silver_flights f {DEP_AIRPORT} GROUP BY ALL""",
    "gold_weather_delay_impact": f"""
SELECT {SKY}, count(*) AS total_flights, {total(flag(HAS_WEATHER))} AS flights_with_weather,
  {rate(HAS_WEATHER, 1)} AS weather_match_pct, {mean('f.dep_delay', 1)} AS avg_dep_delay_min,
  {mean('f.arr_delay', 1)} AS avg_arr_delay_min, {rate('f.dep_delay>0', 1)} AS delayed_flight_pct,
  {mean('f.total_delay_minutes', 1)} AS avg_total_delay_min, {SKY_MEANS}
FROM silver_flights f {WEATHER_JOIN} {DEP_AIRPORT} GROUP BY ALL""",
    "gold_cancellation_analysis": f"""
SELECT {ROUTE}, f.weekday_name, count(*) AS total_events, {total(flag('f.cancelled=1'))} AS cancelled_count,
  {total(flag('f.diverted=1'))} AS diverted_count, {rate('f.cancelled=1', 2)} AS cancellation_rate_pct,
  {rate('f.diverted=1', 2)} AS diversion_rate_pct,
  {mean('CASE WHEN f.diverted=1 THEN f.dep_delay END', 1)} AS diverted_avg_dep_delay_min,
  max(CASE WHEN f.diverted=1 THEN f.dep_delay END) AS diverted_max_dep_delay_min
FROM silver_cancelled f {DEP_AIRPORT} GROUP BY ALL""",
    "gold_weather_cancellation": f"""
SELECT {SKY}, f.flight_month, count(*) AS total_events, {total(flag(HAS_WEATHER))} AS events_with_weather,
  {rate(HAS_WEATHER, 1)} AS weather_match_pct, {total(flag('f.cancelled=1'))} AS cancelled_count,
  {total(flag('f.diverted=1'))} AS diverted_count, {rate('f.cancelled=1', 2)} AS cancellation_rate_pct,
  {rate('f.diverted=1', 2)} AS diversion_rate_pct, {SKY_MEANS}
FROM silver_cancelled f {WEATHER_JOIN} {DEP_AIRPORT} GROUP BY ALL""",
    "gold_ops_summary": _ops_summary("operations"),
    "gold_ops_summary_aligned": _ops_summary("operations_short"),
}


def with_tables(body: str) -> str:
    """Put the named subqueries that the body needs before it."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in TABLES.keys() - needed:
            if re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(TABLES[name])
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in TABLES.items() if n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


# --- queries -----------------------------------------------------------------------

Q: dict[str, str] = {}

# sources and sinks
Q["s1_csv_scan"] = "SELECT * FROM raw_flights"
Q["s2_parquet_roundtrip"] = "SELECT * FROM raw_weather"
Q["s3_partitioned_roundtrip"] = "SELECT * FROM silver_flights"
Q["s4_partition_pruned_scan"] = (
    "SELECT flight_year, flight_month, airline, dep_airport, dep_delay FROM silver_flights WHERE flight_month = 2"
)
for _n in ("flights", "cancelled", "weather", "airports"):
    Q[f"s6_ingest_{_n}"] = f"SELECT * FROM raw_{_n}"
    Q[f"silver_{_n}"] = f"SELECT * FROM silver_{_n}"
Q["s7_airport_sample"] = "SELECT * FROM silver_airports ORDER BY iata_code LIMIT 5"

# projections
Q["p1_rename"] = """SELECT time AS Weather_Date, airport_id AS IATA_CODE, tavg AS Temp_Avg_C, tmin AS Temp_Min_C,
  tmax AS Temp_Max_C, prcp AS Precipitation_mm, snow AS Snowfall_mm, wdir AS Wind_Direction_deg,
  wspd AS Wind_Speed_kmh, pres AS Pressure_hPa FROM raw_weather"""
_TRIMMED = ["FlightDate", "Tail_Number", "Manufacturer", "Model", "Dep_Airport", "Dep_CityName", "Arr_Airport",
            "Arr_CityName", "DepTime_label", "Distance_type", "Dep_Delay_Type", "Arr_Delay_Type"]
Q["p2_trim_strings"] = (
    "SELECT * REPLACE (" + ", ".join(f"trim({c}) AS {c}" for c in _TRIMMED) + ") FROM raw_flights"
)
Q["p3_upper"] = """SELECT Tail_Number, upper(Dep_Airport) AS Dep_Airport, upper(Arr_Airport) AS Arr_Airport,
  upper(Manufacturer) AS Manufacturer FROM raw_flights"""
Q["p4_normalize_key"] = "SELECT IATA_CODE, upper(trim(IATA_CODE)) AS airport_key FROM raw_airports"
Q["p6_lower_columns"] = """SELECT FlightDate AS flightdate, Day_Of_Week AS day_of_week, Airline AS airline,
  Tail_Number AS tail_number, Cancelled AS cancelled, Diverted AS diverted, Dep_Airport AS dep_airport,
  Dep_CityName AS dep_cityname, Arr_Airport AS arr_airport, Arr_CityName AS arr_cityname, DepTime_label AS deptime_label,
  Flight_Duration AS flight_duration, Distance_type AS distance_type, Dep_Delay AS dep_delay,
  Dep_Delay_Tag AS dep_delay_tag, Dep_Delay_Type AS dep_delay_type, Arr_Delay AS arr_delay,
  Arr_Delay_Type AS arr_delay_type, Delay_Carrier AS delay_carrier, Delay_Weather AS delay_weather,
  Delay_NAS AS delay_nas, Delay_Security AS delay_security, Delay_LastAircraft AS delay_lastaircraft FROM raw_cancelled"""

# derived columns
_CAUSES = ", ".join(CAUSE_COLUMNS)
_FLIGHT_TOTAL = f"CASE WHEN {ALL_CAUSES_NULL} THEN NULL ELSE {SUM_OF_CAUSES} END"
_FAILED_TOTAL = f"CASE WHEN Cancelled=1 THEN NULL ELSE {SUM_OF_CAUSES} END"
Q["e1_fix_label"] = f"""SELECT Dep_Delay_Type, {fixed_label('Dep_Delay_Type')} AS dep_fixed, Arr_Delay_Type,
  {fixed_label('Arr_Delay_Type')} AS arr_fixed FROM raw_flights"""
Q["e2_distance_short"] = f"""SELECT Tail_Number, Distance_type, {SHORT_LABEL.format('Distance_type')} AS distance_short
  FROM raw_flights"""
Q["e3_distance_long"] = f"""SELECT Tail_Number, Distance_type, {LONG_LABEL.format('Distance_type')} AS distance_long
  FROM raw_cancelled"""
Q["e4_total_delay"] = f"SELECT {_CAUSES}, {_FLIGHT_TOTAL} AS total_delay FROM raw_flights"
Q["e5_total_delay_diverted"] = f"SELECT Cancelled, {_CAUSES}, {_FAILED_TOTAL} AS total_delay FROM raw_cancelled"
Q["e6_primary_cause"] = f"""SELECT {_CAUSES}, {_FLIGHT_TOTAL} AS total_delay,
  {cause(ALL_CAUSES_NULL, SUM_OF_CAUSES)} AS primary_cause FROM raw_flights"""
Q["e6_primary_cause_fixed"] = f"""SELECT {_CAUSES}, {_FLIGHT_TOTAL} AS total_delay,
  {cause(ALL_CAUSES_NULL, SUM_OF_CAUSES, 'coalesce({},0)')} AS primary_cause FROM raw_flights"""
Q["e7_primary_cause_diverted"] = f"""SELECT Cancelled, {_CAUSES}, {_FAILED_TOTAL} AS total_delay,
  {cause('Cancelled=1', SUM_OF_CAUSES)} AS primary_cause FROM raw_cancelled"""
Q["e8_delay_status"] = f"""SELECT Dep_Delay, {status('Dep_Delay')} AS departure_status, Arr_Delay,
  {status('Arr_Delay')} AS arrival_status FROM raw_flights"""
Q["e9_parse_date"] = f"SELECT FlightDate AS date_text, {PARSED} AS flightdate FROM raw_flights"
Q["e10_date_parts"] = f"""SELECT FlightDate AS flightdate, {part('year', 'FlightDate')} AS Flight_Year,
  {part('month', 'FlightDate')} AS Flight_Month, {part('day', 'FlightDate')} AS Flight_Day FROM raw_cancelled"""
Q["e11_weekday_from_date"] = f"""SELECT FlightDate AS date_text, {PARSED} AS flightdate, dayname({PARSED}) AS weekday
  FROM raw_flights"""
Q["e12_weekday_from_int"] = f"SELECT Day_Of_Week, {WEEKDAY_FROM_INT} AS weekday FROM raw_cancelled"
Q["e13_flight_status"] = f"SELECT Cancelled, Diverted, {FLIGHT_STATUS} AS status FROM raw_cancelled"
Q["e14_nullify"] = (
    "SELECT Cancelled, Diverted, " + ", ".join(f"{v} AS {c}" for c, v in BLANKED.items()) + " FROM raw_cancelled"
)
_WX = "airport_id AS IATA_CODE, time AS Weather_Date"
Q["e15_snow_default"] = f"SELECT {_WX}, coalesce(snow, 0e0) AS Snowfall_mm FROM raw_weather"
Q["e16_season"] = f"""SELECT {_WX}, {part('month', 'time')} AS month, {SEASON.format('month(time)')} AS season
  FROM raw_weather"""
Q["e17_temp_range"] = f"""SELECT {_WX}, tmin AS Temp_Min_C, tmax AS Temp_Max_C, {dround('tmax - tmin', 1)} AS temp_range
  FROM raw_weather"""
Q["e18_is_precipitation"] = f"""SELECT {_WX}, prcp AS Precipitation_mm,
  CASE WHEN prcp IS NULL THEN NULL ELSE prcp > 0 END AS is_precipitation FROM raw_weather"""
Q["e19_wind_category"] = f"SELECT {_WX}, wspd AS Wind_Speed_kmh, {WIND.format('wspd')} AS wind_category FROM raw_weather"
Q["e20_pressure_category"] = f"""SELECT {_WX}, pres AS Pressure_hPa, {PRESSURE.format('pres')} AS pressure_category
  FROM raw_weather"""
Q["e21_us_region"] = f"SELECT IATA_CODE, STATE, {region('STATE')} AS us_region FROM raw_airports"
Q["e22_is_alaska_hawaii"] = """SELECT IATA_CODE, STATE, coalesce(STATE IN ('AK','HI'), FALSE) AS is_alaska_hawaii
  FROM raw_airports"""
Q["e23_round_geo"] = f"""SELECT IATA_CODE, {dround('LATITUDE', 5)} AS latitude_5, {dround('LONGITUDE', 5)} AS longitude_5
  FROM raw_airports"""

# filters, joins, union
_SKY_COLUMNS = """w.weather_season, w.wind_category, w.pressure_category, w.is_precipitation, w.temp_avg_c, w.temp_range_c,
  w.wind_speed_kmh, w.precipitation_mm, w.snowfall_mm"""
_FACT = "f.flightdate, f.tail_number, f.dep_airport, f.dep_delay"
Q["f1_month_window"] = """SELECT flightdate, flight_month, tail_number, flight_status FROM silver_cancelled
  WHERE flight_month IN (1,2,3)"""
Q["j1_airport_broadcast_left"] = f"""SELECT {_FACT}, a.city AS dep_city, a.state AS dep_state, a.us_region AS dep_region
  FROM silver_flights f {DEP_AIRPORT}"""
Q["j2_flights_weather_left"] = f"SELECT {_FACT}, {_SKY_COLUMNS} FROM silver_flights f {WEATHER_JOIN}"
Q["j2_cancelled_weather_left"] = f"SELECT {_FACT}, {_SKY_COLUMNS} FROM silver_cancelled f {WEATHER_JOIN}"
Q["u1_union_operations"] = "SELECT * FROM operations"

# aggregates
Q["a1_dedup"] = Q["a1_dedup_few_copies"] = "SELECT DISTINCT * FROM raw_cancelled"
Q["a5_rate"] = f"""SELECT Tail_Number, {rate('Dep_Delay>0', 1)} AS delayed_pct, {rate('Dep_Delay>0', 2)} AS delayed_pct_2
  FROM raw_flights GROUP BY 1"""
Q["a6_mean"] = f"""SELECT Tail_Number, {mean('Arr_Delay', 1)} AS avg_arr_delay, {mean('Flight_Duration', 2)} AS avg_duration
  FROM raw_flights GROUP BY 1"""
_DIVERTED_DELAY = "CASE WHEN Diverted=1 THEN Dep_Delay END"
Q["a8_conditional_agg"] = f"""SELECT Tail_Number, {mean(_DIVERTED_DELAY, 1)} AS diverted_avg,
  max({_DIVERTED_DELAY}) AS diverted_max FROM raw_cancelled GROUP BY 1"""
Q["a9_ratio"] = f"""SELECT Tail_Number, Day_Of_Week,
  {dround("CAST(sum(CASE WHEN Dep_Delay<=0 THEN 1 WHEN Dep_Delay>0 THEN 0 END) AS DOUBLE)/sum(CASE WHEN Dep_Delay IS NOT NULL THEN 1 END)*100", 1)} AS on_time_pct
  FROM raw_flights GROUP BY 1, 2"""
Q["a10_conditional_count"] = """SELECT Tail_Number, count(*) FILTER (WHERE Dep_Delay IS NULL) AS delay_nulls,
  count(Dep_Delay) AS delay_values FROM raw_cancelled GROUP BY 1"""

# profiling and checks
_FLIGHT_TYPES = {
    **dict.fromkeys(["FlightDate", "Airline", "Tail_Number", "Manufacturer", "Model", "Dep_Airport", "Dep_CityName",
                     "Arr_Airport", "Arr_CityName", "DepTime_label", "Distance_type", "Dep_Delay_Type",
                     "Arr_Delay_Type"], "string"),
    **dict.fromkeys(["Day_Of_Week", "Aicraft_age", "Flight_Duration", "Dep_Delay", "Dep_Delay_Tag", "Arr_Delay",
                     *CAUSE_COLUMNS], "int"),
}
Q["q1_profile_columns"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
    f" count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_count FROM raw_flights"
    for c, t in _FLIGHT_TYPES.items()
)
Q["q2_profile_numeric"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,"
    f" {mean(c, 2)} AS avg_value FROM raw_weather"
    for c in ("tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "pres")
)
_INT_FLIGHTS = [c for c, t in _FLIGHT_TYPES.items() if t == "int"]
Q["q2_profile_numeric_int"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,"
    f" {mean(c, 2)} AS avg_value FROM {source}"
    for source, columns in (("raw_flights", _INT_FLIGHTS), ("orders", ["o_orderkey", "o_custkey"]))
    for c in columns
)
_CSV_COLUMNS = (
    "FlightDate Day_Of_Week Airline Tail_Number Manufacturer Model Aicraft_age Dep_Airport Dep_CityName Arr_Airport Arr_CityName "
    "DepTime_label Flight_Duration Distance_type Dep_Delay Dep_Delay_Tag Dep_Delay_Type Arr_Delay Arr_Delay_Type"
).split() + CAUSE_COLUMNS
_LINE = "concat_ws(',', " + ", ".join(
    f"coalesce({'$$~$$ || ' if c == 'Flight_Duration' else ''}CAST({c} AS VARCHAR), '')" for c in _CSV_COLUMNS
) + ")"
Q["s6_ingest_quarantine"] = f"""SELECT NULL::VARCHAR AS line, count(*) AS n, (SELECT count(*) FROM raw_flights) AS n_lines
FROM raw_flights WHERE Flight_Duration % 25 <> 5
UNION ALL SELECT {_LINE}, 1, (SELECT count(*) FROM raw_flights) FROM raw_flights WHERE Flight_Duration % 25 = 5"""
Q["q3_low_cardinality"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, value FROM (SELECT value, count(*) OVER () AS n FROM"
    f" (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM raw_flights)) WHERE n < 8"
    for c in _FLIGHT_TYPES
)


def _coverage(facts: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    unmatched = "" if by else f"count(*) - count(w.wind_category) AS unmatched,"
    share = "CASE WHEN count(*) = 0 THEN 0e0 ELSE CAST(count(w.wind_category) AS DOUBLE)/count(*)*100 END"
    return f"""SELECT {lead}count(*) AS total, count(w.wind_category) AS matched, {unmatched}
  {dround(share, 1)} AS match_pct FROM {facts} f {WEATHER_JOIN} {DEP_AIRPORT} {f'GROUP BY {by}' if by else ''}"""


Q["q4_weather_coverage_flights"] = _coverage("silver_flights")
Q["q4_weather_coverage_cancelled"] = _coverage("silver_cancelled")
Q["q5_coverage_by_month"] = _coverage("silver_cancelled", "f.flight_month")


def _nulls(table: str, cols: list[str]) -> str:
    return "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in cols) + f" FROM {table}"


Q["q6_nulls_weather"] = _nulls(
    "silver_weather",
    ["temp_avg_c", "precipitation_mm", "wind_speed_kmh", "wind_direction_deg", "pressure_hpa", "snowfall_mm"],
)
Q["q6_nulls_airports"] = _nulls("silver_airports", ["iata_code", "state", "us_region", "latitude", "longitude"])
for _n, _columns in (("flights", 33), ("cancelled", 31), ("weather", 19), ("airports", 10)):
    Q[f"q7_audit_{_n}"] = f"""SELECT (SELECT count(*) FROM raw_{_n}) AS bronze_rows,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{_n})) AS rows_after_dedup,
  (SELECT count(*) FROM raw_{_n}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{_n})) AS duplicates_removed,
  (SELECT count(*) FROM silver_{_n}) AS silver_rows, CAST({_columns} AS INTEGER) AS silver_columns"""
Q["duplicate_airports"] = "SELECT IATA_CODE, count(*) AS rows FROM raw_airports GROUP BY IATA_CODE HAVING count(*) > 1"


def _counts(tables: dict[str, tuple[str, int]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({n} AS INTEGER) AS column_count FROM {source}"
        for name, (source, n) in tables.items()
    )


Q["q8_union_scope"] = _counts(
    {
        "flights": ("silver_flights", 33),
        "cancelled_all": ("silver_cancelled", 31),
        "cancelled_window": ("silver_cancelled WHERE flight_month IN (1,2,3)", 31),
        "union": ("operations", 18),
        "gold_ops_summary": ("gold_ops_summary", 23),
    }
)

# gold tables
_GOLD_COLUMNS = {
    "flight_performance": 22,
    "weather_delay_impact": 17,
    "cancellation_analysis": 18,
    "weather_cancellation": 18,
    "ops_summary": 23,
}
for _n in _GOLD_COLUMNS:
    Q[f"gold_{_n}"] = f"SELECT * FROM gold_{_n}"
for _n in _GOLD_COLUMNS:
    Q[f"merged_{_n}"] = f"SELECT * FROM gold_{_n}"
Q["medallion_gold"] = "SELECT * FROM gold_weather_delay_impact"
Q["gold_ops_summary_aligned"] = "SELECT * FROM gold_ops_summary_aligned"
Q["medallion_tables"] = _counts(
    {
        "bronze_flights": ("raw_flights", 24),
        "bronze_cancelled": ("raw_cancelled", 23),
        "bronze_weather": ("raw_weather", 10),
        "bronze_airports": ("raw_airports", 7),
        "silver_flights": ("silver_flights", 33),
        "silver_cancelled": ("silver_cancelled", 31),
        "silver_weather": ("silver_weather", 19),
        "silver_airports": ("silver_airports", 10),
        **{f"gold_{n}": (f"gold_{n}", columns) for n, columns in _GOLD_COLUMNS.items()},
    }
)


# reports
def _frequency(table: str, col: str, where: str = "") -> str:
    return f"SELECT {col}, count(*) AS count FROM {table} {where} GROUP BY {col}"


Q["r1_departure_status"] = _frequency("silver_flights", "departure_status")
Q["r2_arrival_status"] = _frequency("silver_flights", "arrival_status")
Q["r3_primary_cause"] = _frequency("silver_flights", "primary_delay_cause")
Q["r4_distance_flights"] = _frequency("silver_flights", "distance_type")
Q["r5_flight_status"] = _frequency("silver_cancelled", "flight_status")
Q["r6_distance_cancelled"] = _frequency("silver_cancelled", "distance_type")
Q["r7_cause_diverted"] = _frequency("silver_cancelled", "primary_delay_cause", "WHERE diverted = 1")
Q["r8_delay_nulls_by_status"] = """SELECT flight_status, count(*) - count(dep_delay) AS dep_delay_nulls,
  count(dep_delay) AS dep_delay_values FROM silver_cancelled GROUP BY flight_status"""
Q["r9_season"] = _frequency("silver_weather", "weather_season")
Q["r10_wind"] = _frequency("silver_weather", "wind_category")
Q["r11_pressure"] = _frequency("silver_weather", "pressure_category")
Q["r12_precip"] = _frequency("silver_weather", "is_precipitation")
Q["r13_region"] = _frequency("silver_airports", "us_region")
Q["r14_alaska_hawaii"] = _frequency("silver_airports", "is_alaska_hawaii")
Q["r25_status_split"] = _frequency("operations", "flight_status")

_ROUTE_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("flight_year", "flight_month", "airline", "dep_airport", "dep_city", "dep_state", "dep_region",
              "arr_airport", "arr_cityname", "distance_type")
)
Q["r15_top_routes"] = f"""SELECT * FROM gold_flight_performance
  ORDER BY avg_dep_delay_min DESC NULLS LAST, {_ROUTE_ORDER} LIMIT 10"""
Q["r30_worst_routes"] = f"""SELECT dep_airport, arr_airport, airline, total_scheduled, cancelled_count,
  cancellation_rate_pct, avg_dep_delay_min FROM gold_ops_summary WHERE total_scheduled >= {WORST_ROUTE_MIN_SCHEDULED}
  ORDER BY cancellation_rate_pct DESC NULLS LAST, {_ROUTE_ORDER}, weekday_name NULLS FIRST LIMIT 10"""

_CANCEL_RATE = f"{exact_mean('cancellation_rate_pct', 2)} AS cancel_rate_pct"
_COMPLETION = f"{exact_mean('completion_rate_pct', 2)} AS completion_rate_pct"
_ON_TIME = f"{exact_mean('on_time_pct', 1)} AS on_time_pct"
_WX_DELAY = f"{exact_mean('avg_dep_delay_min', 1)} AS avg_dep_delay, {exact_mean('delayed_flight_pct', 1)} AS delayed_pct"
_FLIGHTS = f"{total('total_flights')} AS total_flights"
_EVENTS = f"{total('total_events')} AS total_events"
_SCHEDULED = f"{total('total_scheduled')} AS total_scheduled"
_CANCELLED = f"{total('cancelled_count')} AS cancelled"
# report -> (gold table, key, outputs, order and limit)
_REPORTS = {
    "ontime_by_airline": ("flight_performance", "airline", [f"{exact_mean('on_time_pct', 1)} AS avg_on_time_pct"],
                          "ORDER BY avg_on_time_pct DESC NULLS LAST, airline NULLS FIRST"),
    "perf_by_region": ("flight_performance", "dep_region",
                       [f"{exact_mean('avg_dep_delay_min', 1)} AS avg_dep_delay", _ON_TIME, _FLIGHTS], ""),
    "delay_by_wind": ("weather_delay_impact", "wind_category", [_WX_DELAY, _FLIGHTS], ""),
    "delay_by_pressure": ("weather_delay_impact", "pressure_category", [_WX_DELAY], ""),
    "delay_by_precip": ("weather_delay_impact", "is_precipitation", [_WX_DELAY, _FLIGHTS], ""),
    "cancel_by_airline": ("cancellation_analysis", "airline",
                          [_EVENTS, _CANCELLED, f"{exact_mean('cancellation_rate_pct', 2)} AS avg_cancel_rate_pct"],
                          "ORDER BY avg_cancel_rate_pct DESC NULLS LAST, airline NULLS FIRST"),
    "cancel_by_month": ("cancellation_analysis", "flight_month", [_EVENTS, _CANCELLED, _CANCEL_RATE],
                        "ORDER BY flight_month NULLS FIRST"),
    "cancel_by_region": ("cancellation_analysis", "dep_region", [_EVENTS, _CANCEL_RATE], ""),
    "cancel_by_weekday": ("cancellation_analysis", "weekday_name", [_EVENTS, _CANCEL_RATE], ""),
    "ops_by_airline": ("ops_summary", "airline",
                       [_SCHEDULED, f"{total('completed_count')} AS completed", _CANCELLED, _CANCEL_RATE, _COMPLETION],
                       "ORDER BY cancel_rate_pct NULLS FIRST, airline NULLS FIRST"),
    "ops_by_month": ("ops_summary", "flight_month", [_SCHEDULED, _CANCELLED, _CANCEL_RATE, _COMPLETION], ""),
    "ops_by_region": ("ops_summary", "dep_region", [_SCHEDULED, _CANCELLED, _CANCEL_RATE, _ON_TIME], ""),
    "ops_by_weekday": ("ops_summary", "weekday_name",
                       [_SCHEDULED, _CANCEL_RATE, _ON_TIME,
                        f"{exact_mean('avg_dep_delay_min', 1)} AS avg_dep_delay_min"], ""),
    "wx_cancel_by_wind": ("weather_cancellation", "wind_category",
                          [_EVENTS, _CANCELLED, _CANCEL_RATE,
                           f"{exact_mean('avg_wind_speed_kmh', 1)} AS avg_wind_kmh"], ""),
    "wx_cancel_by_pressure": ("weather_cancellation", "pressure_category", [_EVENTS, _CANCEL_RATE], ""),
    "wx_cancel_by_precip": ("weather_cancellation", "is_precipitation",
                            [_EVENTS, _CANCEL_RATE, f"{exact_mean('avg_precipitation_mm', 2)} AS avg_precip_mm"], ""),
    "wx_cancel_by_season": ("weather_cancellation", "weather_season",
                            [_EVENTS, _CANCELLED, _CANCEL_RATE,
                             f"{exact_mean('avg_snowfall_mm', 2)} AS avg_snowfall_mm"], ""),
    "wx_cancel_by_region": ("weather_cancellation", "dep_region", [_EVENTS, _CANCEL_RATE], ""),
}
for _id, _n in GOLD_REPORT_QUERIES.items():
    _table, _key, _outputs, _order = _REPORTS[_n]
    Q[f"{_id}_{_n}"] = f"SELECT {_key}, {', '.join(_outputs)} FROM gold_{_table} GROUP BY {_key} {_order}"

_WEIGHTED = "CAST(sum(CAST(cancellation_rate_pct AS DECIMAL(18,4)) * total_events) AS DOUBLE)"
Q["weighted_cancel_by_region"] = f"""SELECT dep_region, {_EVENTS},
  {dround(f"{_WEIGHTED} / sum(CASE WHEN cancellation_rate_pct IS NOT NULL THEN total_events END)", 2)} AS cancel_rate_pct
  FROM gold_cancellation_analysis GROUP BY dep_region"""

ORACLE_SQL: dict[str, str] = {name: with_tables(body) for name, body in Q.items()}
