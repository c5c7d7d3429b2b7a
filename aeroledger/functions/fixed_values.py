"""Fixed values.

Names, labels, limits and formats that the input files and the result tables
agree on. Results are only right while these stay exactly as they are.
"""

# --- Fixed values: input files ------------------------------------------------

RAW_FILES = {
    "flights": "US_flights_2023.csv",
    "cancelled": "Cancelled_Diverted_2023.csv",
    "weather": "weather_meteo_by_airport.csv",
    "airports": "airports_geolocation.csv",
}

# Folders of tables that are not named like the table.
TABLE_FOLDERS = {"cancelled": "cancelled_flights", "ops_summary": "ops_summary_3month"}

RAW_SCHEMAS = {
    "flights": """
        FlightDate string, Day_Of_Week int, Airline string, Tail_Number string,
        Manufacturer string, Model string, Aicraft_age int,
        Dep_Airport string, Dep_CityName string, Arr_Airport string, Arr_CityName string,
        DepTime_label string, Flight_Duration int, Distance_type string,
        Dep_Delay int, Dep_Delay_Tag int, Dep_Delay_Type string,
        Arr_Delay int, Arr_Delay_Type string,
        Delay_Carrier int, Delay_Weather int, Delay_NAS int, Delay_Security int,
        Delay_LastAircraft int
    """,
    "cancelled": """
        FlightDate date, Day_Of_Week int, Airline string, Tail_Number string,
        Cancelled int, Diverted int,
        Dep_Airport string, Dep_CityName string, Arr_Airport string, Arr_CityName string,
        DepTime_label string, Flight_Duration int, Distance_type string,
        Dep_Delay int, Dep_Delay_Tag int, Dep_Delay_Type string,
        Arr_Delay int, Arr_Delay_Type string,
        Delay_Carrier int, Delay_Weather int, Delay_NAS int, Delay_Security int,
        Delay_LastAircraft int
    """,
    "weather": """
        time date, airport_id string, tavg double, tmin double, tmax double,
        prcp double, snow double, wdir double, wspd double, pres double
    """,
    "airports": """
        IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string,
        LATITUDE double, LONGITUDE double
    """,
}

FLIGHT_DATE_FORMAT = "dd-MM-yyyy"

# --- Fixed values: renames ----------------------------------------------------

FLIGHT_NAMES = {"Aicraft_age": "Aircraft_age"}

WEATHER_NAMES = {
    "time": "Weather_Date",
    "airport_id": "IATA_CODE",
    "tavg": "Temp_Avg_C",
    "tmin": "Temp_Min_C",
    "tmax": "Temp_Max_C",
    "prcp": "Precipitation_mm",
    "snow": "Snowfall_mm",
    "wdir": "Wind_Direction_deg",
    "wspd": "Wind_Speed_kmh",
    "pres": "Pressure_hPa",
}

AIRPORT_NAMES = {
    "AIRPORT": "Airport_Name",
    "CITY": "City",
    "STATE": "State",
    "COUNTRY": "Country",
    "LATITUDE": "Latitude",
    "LONGITUDE": "Longitude",
}

# --- Fixed values: labels -----------------------------------------------------

MISSPELT_HIGH = "(?i)Hight"

SHORT_DISTANCE_LABELS = {
    "Short Haul >1500Mi": "Short Haul",
    "Medium Haul <3000Mi": "Medium Haul",
    "Long Haul <6000Mi": "Long Haul",
}

LONG_DISTANCE_LABELS = {
    "Short Haul": "Short Haul >1500Mi",
    "Medium Haul": "Medium Haul <3000Mi",
    "Long Haul": "Long Haul <6000Mi",
}

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Delay cause label -> column; on a tie the earlier cause wins.
DELAY_CAUSES = {
    "Carrier": "Delay_Carrier",
    "Weather": "Delay_Weather",
    "NAS": "Delay_NAS",
    "Security": "Delay_Security",
    "LastAircraft": "Delay_LastAircraft",
}

# Columns that say nothing about a flight that never left.
BLANK_WHEN_CANCELLED = [
    "Dep_Delay", "Dep_Delay_Tag", "Dep_Delay_Type",
    "Arr_Delay", "Arr_Delay_Type",
    "Delay_Carrier", "Delay_Weather", "Delay_NAS", "Delay_Security", "Delay_LastAircraft",
    "Flight_Duration",
]

SEASON_MONTHS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}

# (comparison, limit, label); the first that holds names the bucket.
WIND_STEPS = [("==", 0, "Calm"), ("<=", 20, "Light"), ("<=", 40, "Moderate"), ("<=", 60, "Strong")]
WIND_ABOVE = "Severe"
PRESSURE_STEPS = [("<", 1000, "Low"), ("<=", 1020, "Normal")]
PRESSURE_ABOVE = "High"

REGION_STATES = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NY", "NJ", "PA"],
    "Southeast": ["DE", "MD", "VA", "WV", "NC", "SC", "GA", "FL", "AL", "MS", "TN", "KY", "AR", "LA"],
    "Midwest": ["OH", "MI", "IN", "WI", "IL", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "Southwest": ["TX", "OK", "NM", "AZ"],
    "West": ["CO", "WY", "MT", "ID", "WA", "OR", "CA", "NV", "UT"],
    "Pacific": ["AK", "HI"],
}
ALASKA_HAWAII = ["AK", "HI"]

# --- Fixed values: silver tables ------------------------------------------------

SILVER_SCHEMAS = {
    "flights": """
        flightdate date, flight_year int, flight_month int, flight_day int,
        day_of_week int, weekday_name string, airline string, tail_number string,
        manufacturer string, model string, aircraft_age int,
        dep_airport string, dep_cityname string, arr_airport string, arr_cityname string,
        deptime_label string, flight_duration int, distance_type string,
        dep_delay int, dep_delay_tag int, dep_delay_type string, departure_status string,
        arr_delay int, arr_delay_type string, arrival_status string,
        delay_carrier int, delay_weather int, delay_nas int, delay_security int,
        delay_lastaircraft int, total_delay_minutes int, primary_delay_cause string,
        silver_load_timestamp timestamp
    """,
    "cancelled": """
        flightdate date, flight_year int, flight_month int, flight_day int,
        day_of_week int, weekday_name string, airline string, tail_number string,
        cancelled int, diverted int, flight_status string,
        dep_airport string, dep_cityname string, arr_airport string, arr_cityname string,
        deptime_label string, flight_duration int, distance_type string,
        dep_delay int, dep_delay_tag int, dep_delay_type string,
        arr_delay int, arr_delay_type string,
        delay_carrier int, delay_weather int, delay_nas int, delay_security int,
        delay_lastaircraft int, total_delay_minutes int, primary_delay_cause string,
        silver_load_timestamp timestamp
    """,
    "weather": """
        iata_code string, weather_date date, weather_year int, weather_month int,
        weather_day int, weather_season string,
        temp_avg_c double, temp_min_c double, temp_max_c double, temp_range_c double,
        precipitation_mm double, is_precipitation boolean, snowfall_mm double,
        wind_speed_kmh double, wind_direction_deg double, wind_category string,
        pressure_hpa double, pressure_category string, silver_load_timestamp timestamp
    """,
    "airports": """
        iata_code string, airport_name string, city string, state string, country string,
        latitude double, longitude double, us_region string, is_alaska_hawaii boolean,
        silver_load_timestamp timestamp
    """,
}

SILVER_PARTITIONS = {
    "flights": ["flight_year", "flight_month"],
    "cancelled": ["flight_year", "flight_month"],
    "weather": ["weather_year", "weather_month"],
    "airports": [],
}

GOLD_PARTITIONS = {
    "flight_performance": ["flight_year", "flight_month"],
    "weather_delay_impact": [],
    "cancellation_analysis": ["flight_year", "flight_month"],
    "weather_cancellation": [],
    "ops_summary": ["flight_year", "flight_month"],
}

# --- Fixed values: the view over all scheduled flights ------------------------------

OPERATION_COLUMNS = [
    "flightdate", "flight_year", "flight_month", "flight_day",
    "day_of_week", "weekday_name", "airline", "tail_number",
    "dep_airport", "dep_cityname", "arr_airport", "arr_cityname",
    "deptime_label", "distance_type", "dep_delay", "arr_delay", "flight_duration",
]
OPERATION_MONTHS = [1, 2, 3]

WEATHER_FACTS = [
    "weather_season", "wind_category", "pressure_category", "is_precipitation",
    "temp_avg_c", "temp_range_c", "wind_speed_kmh", "precipitation_mm", "snowfall_mm",
]

LOW_CARDINALITY = 8
WORST_ROUTE_MIN_SCHEDULED = 50
