"""One registered query per operator, table and report."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.functions import dates, delays, labels, measures
from aeroledger.functions import fixed_values as fixed
from aeroledger.operators import joins, profiling, rows, shaping
from aeroledger.operators.summarize import aggregate, averaged, largest
from aeroledger.plans import gold, medallion, reports, silver, states
from aeroledger.sources import files
from harness.fixtures import raw, scratch_dir, write_raw_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# r30 on the derived inputs: their groups are small, so the default of 50 would keep none.
WORST_ROUTE_MIN_SCHEDULED = 3


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class Tables:
    """Raw and silver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name)

    def silver(self, name: str, **options) -> DataFrame:
        return silver.SILVER[name](self.raw(name), **options)

    def gold(self, name: str) -> DataFrame:
        build, sources = medallion.GOLD[name]
        return build(*[self.silver(s) for s in sources])


def _stamped(df: DataFrame) -> DataFrame:
    """The load time differs from run to run; show only that it is set."""
    stamp = F.col("silver_load_timestamp").isNotNull().alias("load_timestamp_set")
    return df.select(*[c for c in df.columns if c != "silver_load_timestamp"], stamp)


# --- sources and sinks ---------------------------------------------------------------


def _csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = scratch_dir(spark)
    write_raw_csv(raw(spark, sf_dir, name), f"{folder}/{fixed.RAW_FILES[name]}")
    return folder


@query
def s1_csv_scan(spark, sf_dir):
    path = f"{_csv(spark, sf_dir, 'flights')}/{fixed.RAW_FILES['flights']}"
    return files.read_raw_csv(spark, path, fixed.RAW_SCHEMAS["flights"])


@query
def s2_parquet_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark)}/weather"
    files.replace_table(raw(spark, sf_dir, "weather"), path)
    return files.read_table(spark, path)


def _partitioned_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/flights"
    files.replace_table(Tables(spark, sf_dir).silver("flights"), path, fixed.SILVER_PARTITIONS["flights"])
    return files.read_table(spark, path, fixed.SILVER_SCHEMAS["flights"])


@query
def s3_partitioned_roundtrip(spark, sf_dir):
    return _stamped(_partitioned_flights(spark, sf_dir))


@query
def s4_partition_pruned_scan(spark, sf_dir):
    february = rows.in_months(_partitioned_flights(spark, sf_dir), [2])
    return february.select("flight_year", "flight_month", "airline", "dep_airport", "dep_delay")


def _ingest_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _csv(spark, sf_dir, name)
        files.ingest(spark, name, folder, f"{folder}/bronze")
        return files.read_table(spark, files.table_path(f"{folder}/bronze", name))

    return run


for _name in fixed.RAW_FILES:
    QUERIES[f"s6_ingest_{_name}"] = _ingest_query(_name)


@query
def s6_ingest_quarantine(spark, sf_dir):
    """Rejected lines one by one, and the number of the rows loaded."""
    folder = scratch_dir(spark)
    duration = F.when(F.col("Flight_Duration") % 25 == 5, F.concat(F.lit("~"), "Flight_Duration")).otherwise(F.col("Flight_Duration").cast("string"))
    write_raw_csv(raw(spark, sf_dir, "flights").withColumn("Flight_Duration", duration), f"{folder}/{fixed.RAW_FILES['flights']}")
    counted = files.ingest_with_quarantine(spark, "flights", folder, f"{folder}/bronze")
    loaded = files.read_bronze(spark, "flights", f"{folder}/bronze").agg(F.lit(None).cast("string").alias("line"), F.count("*").alias("n"))
    rejected = files.rejected_lines(spark, "flights", f"{folder}/bronze").select("line", F.lit(1).cast("bigint").alias("n"))
    return loaded.unionByName(rejected).withColumn("n_lines", F.lit(counted.lines).cast("bigint"))


@query
def s7_airport_sample(spark, sf_dir):
    return _stamped(rows.sample_rows(Tables(spark, sf_dir).silver("airports"), "iata_code"))


# --- projections -----------------------------------------------------------------------


@query
def p1_rename(spark, sf_dir):
    return shaping.rename(raw(spark, sf_dir, "weather"), fixed.WEATHER_NAMES)


@query
def p2_trim_strings(spark, sf_dir):
    return shaping.trim_strings(raw(spark, sf_dir, "flights"), exclude=["Airline"])


@query
def p3_upper(spark, sf_dir):
    flights = raw(spark, sf_dir, "flights").select("Tail_Number", "Dep_Airport", "Arr_Airport", "Manufacturer")
    return shaping.upper_cols(flights, ["Dep_Airport", "Arr_Airport", "Manufacturer"])


@query
def p4_normalize_key(spark, sf_dir):
    return raw(spark, sf_dir, "airports").select("IATA_CODE", labels.normalize_key("IATA_CODE").alias("airport_key"))


@query
def p6_lower_columns(spark, sf_dir):
    return shaping.lower_columns(raw(spark, sf_dir, "cancelled"))


# --- derived columns ----------------------------------------------------------------------

CAUSES = list(fixed.DELAY_CAUSES.values())


@query
def e1_fix_label(spark, sf_dir):
    return raw(spark, sf_dir, "flights").select(
        "Dep_Delay_Type",
        labels.fix_label("Dep_Delay_Type").alias("dep_fixed"),
        "Arr_Delay_Type",
        labels.fix_label("Arr_Delay_Type").alias("arr_fixed"),
    )


@query
def e2_distance_short(spark, sf_dir):
    short = labels.map_labels("Distance_type", fixed.SHORT_DISTANCE_LABELS)
    return raw(spark, sf_dir, "flights").select("Tail_Number", "Distance_type", short.alias("distance_short"))


@query
def e3_distance_long(spark, sf_dir):
    long = labels.map_labels("Distance_type", fixed.LONG_DISTANCE_LABELS)
    return raw(spark, sf_dir, "cancelled").select("Tail_Number", "Distance_type", long.alias("distance_long"))


@query
def e4_total_delay(spark, sf_dir):
    return raw(spark, sf_dir, "flights").select(*CAUSES, delays.sum_or_null(CAUSES).alias("total_delay"))


def _failed_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = delays.sum_unless(CAUSES, "Cancelled = 1")
    return raw(spark, sf_dir, "cancelled").select("Cancelled", *CAUSES, total.alias("total_delay"))


@query
def e5_total_delay_diverted(spark, sf_dir):
    return _failed_with_total(spark, sf_dir)


def _flights_with_cause(spark: SparkSession, sf_dir: str, nulls_as_zero: bool) -> DataFrame:
    cause = delays.argmax_label(fixed.DELAY_CAUSES, "total_delay", nulls_as_zero=nulls_as_zero)
    return e4_total_delay(spark, sf_dir).withColumn("primary_cause", cause)


@query
def e6_primary_cause(spark, sf_dir):
    return _flights_with_cause(spark, sf_dir, nulls_as_zero=False)


@query
def e6_primary_cause_fixed(spark, sf_dir):
    return _flights_with_cause(spark, sf_dir, nulls_as_zero=True)


@query
def e7_primary_cause_diverted(spark, sf_dir):
    cause = delays.argmax_label(fixed.DELAY_CAUSES, "total_delay", blank_when="Cancelled = 1")
    return _failed_with_total(spark, sf_dir).withColumn("primary_cause", cause)


@query
def e8_delay_status(spark, sf_dir):
    return raw(spark, sf_dir, "flights").select(
        "Dep_Delay",
        labels.delay_status("Dep_Delay").alias("departure_status"),
        "Arr_Delay",
        labels.delay_status("Arr_Delay").alias("arrival_status"),
    )


def _dated_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = dates.parse_date("FlightDate", fixed.FLIGHT_DATE_FORMAT)
    return raw(spark, sf_dir, "flights").select(F.col("FlightDate").alias("date_text"), parsed.alias("flightdate"))


@query
def e9_parse_date(spark, sf_dir):
    return _dated_flights(spark, sf_dir)


@query
def e10_date_parts(spark, sf_dir):
    cancelled = raw(spark, sf_dir, "cancelled").select(F.col("FlightDate").alias("flightdate"))
    return cancelled.withColumns(dates.date_parts("flightdate", "Flight"))


@query
def e11_weekday_from_date(spark, sf_dir):
    return _dated_flights(spark, sf_dir).withColumn("weekday", dates.weekday_name("flightdate"))


@query
def e12_weekday_from_int(spark, sf_dir):
    return raw(spark, sf_dir, "cancelled").select(
        "Day_Of_Week", labels.weekday_from_int("Day_Of_Week").alias("weekday")
    )


@query
def e13_flight_status(spark, sf_dir):
    status = labels.flight_status("Cancelled", "Diverted")
    return raw(spark, sf_dir, "cancelled").select("Cancelled", "Diverted", status.alias("status"))


@query
def e14_nullify(spark, sf_dir):
    cancelled = raw(spark, sf_dir, "cancelled").select("Cancelled", "Diverted", *fixed.BLANK_WHEN_CANCELLED)
    return shaping.nullify(cancelled, fixed.BLANK_WHEN_CANCELLED, F.col("Cancelled") == 1)


def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.rename(raw(spark, sf_dir, "weather"), fixed.WEATHER_NAMES)


WEATHER_ID = ["IATA_CODE", "Weather_Date"]


@query
def e15_snow_default(spark, sf_dir):
    return shaping.fill(_weather(spark, sf_dir).select(*WEATHER_ID, "Snowfall_mm"), {"Snowfall_mm": 0.0})


@query
def e16_season(spark, sf_dir):
    months = _weather(spark, sf_dir).select(*WEATHER_ID, F.month("Weather_Date").alias("month"))
    return months.withColumn("season", labels.season("month"))


@query
def e17_temp_range(spark, sf_dir):
    spread = measures.temp_range("Temp_Min_C", "Temp_Max_C")
    return _weather(spark, sf_dir).select(*WEATHER_ID, "Temp_Min_C", "Temp_Max_C", spread.alias("temp_range"))


@query
def e18_is_precipitation(spark, sf_dir):
    wet = measures.positive_flag("Precipitation_mm")
    return _weather(spark, sf_dir).select(*WEATHER_ID, "Precipitation_mm", wet.alias("is_precipitation"))


@query
def e19_wind_category(spark, sf_dir):
    wind = labels.bucket("Wind_Speed_kmh", fixed.WIND_STEPS, fixed.WIND_ABOVE)
    return _weather(spark, sf_dir).select(*WEATHER_ID, "Wind_Speed_kmh", wind.alias("wind_category"))


@query
def e20_pressure_category(spark, sf_dir):
    pressure = labels.bucket("Pressure_hPa", fixed.PRESSURE_STEPS, fixed.PRESSURE_ABOVE)
    return _weather(spark, sf_dir).select(*WEATHER_ID, "Pressure_hPa", pressure.alias("pressure_category"))


@query
def e21_us_region(spark, sf_dir):
    region = labels.group_of("STATE", fixed.REGION_STATES)
    return raw(spark, sf_dir, "airports").select("IATA_CODE", "STATE", region.alias("us_region"))


@query
def e22_is_alaska_hawaii(spark, sf_dir):
    flag = labels.is_in("STATE", fixed.ALASKA_HAWAII)
    return raw(spark, sf_dir, "airports").select("IATA_CODE", "STATE", flag.alias("is_alaska_hawaii"))


@query
def e23_round_geo(spark, sf_dir):
    return raw(spark, sf_dir, "airports").select(
        "IATA_CODE", F.round("LATITUDE", 5).alias("latitude_5"), F.round("LONGITUDE", 5).alias("longitude_5")
    )


# --- filters, joins, union -------------------------------------------------------------------


@query
def f1_month_window(spark, sf_dir):
    window = rows.in_months(Tables(spark, sf_dir).silver("cancelled"), fixed.OPERATION_MONTHS)
    return window.select("flightdate", "flight_month", "tail_number", "flight_status")


@query
def j1_airport_broadcast_left(spark, sf_dir):
    t = Tables(spark, sf_dir)
    flights = t.silver("flights").select("flightdate", "tail_number", "dep_airport", "dep_delay")
    return joins.with_airport(flights, t.silver("airports"))


def _weather_join(spark: SparkSession, sf_dir: str, facts: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    slim = t.silver(facts).select("flightdate", "tail_number", "dep_airport", "dep_delay")
    return joins.with_weather(slim, t.silver("weather"))


@query
def j2_flights_weather_left(spark, sf_dir):
    return _weather_join(spark, sf_dir, "flights")


@query
def j2_cancelled_weather_left(spark, sf_dir):
    return _weather_join(spark, sf_dir, "cancelled")


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return rows.union_operations(t.silver("flights"), t.silver("cancelled"), fixed.OPERATION_MONTHS)


@query
def u1_union_operations(spark, sf_dir):
    return _operations(spark, sf_dir)


# --- aggregates ----------------------------------------------------------------------------------


@query
def a1_dedup(spark, sf_dir):
    return rows.drop_copies(raw(spark, sf_dir, "cancelled"))


@query
def a1_dedup_few_copies(spark, sf_dir):
    return rows.drop_copies(raw(spark, sf_dir, "cancelled"), few=True)


@query
def a5_rate(spark, sf_dir):
    shares = [averaged("delayed_pct", gold.DELAYED, 1, percent=True), averaged("delayed_pct_2", gold.DELAYED, 2, percent=True)]
    return aggregate(raw(spark, sf_dir, "flights"), ["Tail_Number"], shares)


@query
def a6_mean(spark, sf_dir):
    means = [averaged("avg_arr_delay", "Arr_Delay", 1), averaged("avg_duration", "Flight_Duration", 2)]
    return aggregate(raw(spark, sf_dir, "flights"), ["Tail_Number"], means)


@query
def a8_conditional_agg(spark, sf_dir):
    found = [averaged("diverted_avg", gold.DIVERTED_DELAY, 1), largest("diverted_max", gold.DIVERTED_DELAY)]
    return aggregate(raw(spark, sf_dir, "cancelled"), ["Tail_Number"], found)


@query
def a9_ratio(spark, sf_dir):
    share = [averaged("on_time_pct", gold.ON_TIME, 1, percent=True)]
    return aggregate(raw(spark, sf_dir, "flights"), ["Tail_Number", "Day_Of_Week"], share)


@query
def a10_conditional_count(spark, sf_dir):
    return raw(spark, sf_dir, "cancelled").groupBy("Tail_Number").agg(
        F.count_if(F.col("Dep_Delay").isNull()).alias("delay_nulls"),
        F.count_if(F.col("Dep_Delay").isNotNull()).alias("delay_values"),
    )


# --- profiling and checks -----------------------------------------------------------------------


@query
def q1_profile_columns(spark, sf_dir):
    return profiling.profile_columns(raw(spark, sf_dir, "flights"))


@query
def q1_profile_sketch(spark, sf_dir):
    flights = raw(spark, sf_dir, "flights")
    early = F.coalesce(F.col("Day_Of_Week") < 4, F.lit(False))
    parts = profiling.sketch_columns(flights.filter(early)).unionByName(profiling.sketch_columns(flights.filter(~early)))
    return profiling.profile_sketches(profiling.merge_sketches(parts))


@query
def q2_profile_numeric(spark, sf_dir):
    return profiling.profile_numeric(raw(spark, sf_dir, "weather"))


@query
def q2_profile_numeric_int(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("int"))
    return profiling.profile_numeric(raw(spark, sf_dir, "flights")).unionByName(profiling.profile_numeric(orders))


@query
def q3_low_cardinality(spark, sf_dir):
    return profiling.low_cardinality(raw(spark, sf_dir, "flights"))


def _coverage(spark: SparkSession, sf_dir: str, facts: str, by: tuple[str, ...] = ()) -> DataFrame:
    t = Tables(spark, sf_dir)
    return gold.weather_coverage(t.silver(facts), t.silver("weather"), t.silver("airports"), by)


@query
def q4_weather_coverage_flights(spark, sf_dir):
    return _coverage(spark, sf_dir, "flights")


@query
def q4_weather_coverage_cancelled(spark, sf_dir):
    return _coverage(spark, sf_dir, "cancelled")


@query
def q5_coverage_by_month(spark, sf_dir):
    covered = _coverage(spark, sf_dir, "cancelled", ("flight_month",))
    return covered.drop("unmatched").orderBy(F.col("flight_month").asc_nulls_first())


@query
def q6_nulls_weather(spark, sf_dir):
    cols = ["temp_avg_c", "precipitation_mm", "wind_speed_kmh", "wind_direction_deg", "pressure_hpa", "snowfall_mm"]
    return profiling.null_counts(Tables(spark, sf_dir).silver("weather"), cols)


@query
def q6_nulls_airports(spark, sf_dir):
    cols = ["iata_code", "state", "us_region", "latitude", "longitude"]
    return profiling.null_counts(Tables(spark, sf_dir).silver("airports"), cols)


def _audit_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = raw(spark, sf_dir, name)
        return profiling.audit_cleaning(source, rows.drop_copies(source), silver.SILVER[name](source))

    return run


for _name in fixed.RAW_FILES:
    QUERIES[f"q7_audit_{_name}"] = _audit_query(_name)


@query
def duplicate_airports(spark, sf_dir):
    return rows.duplicate_keys(raw(spark, sf_dir, "airports"), ["IATA_CODE"])


def _states(spark: SparkSession, sf_dir: str, by_month: bool = False) -> list[DataFrame]:
    """Stored partial results of flights and failed flights, written at once or month by month."""
    t, folder, stored = Tables(spark, sf_dir), scratch_dir(spark), []
    for name, make in (("flights", states.flight_states), ("cancelled", states.failure_states)):
        facts, path = t.silver(name), f"{folder}/{name}"
        early = F.coalesce(F.col("flight_month") == 1, F.lit(False))
        for part in (facts.filter(early), facts.filter(~early)) if by_month else (facts,):
            states.store(make(part), path)
        stored.append(states.stored(spark, path))
    return stored


@query
def q8_union_scope(spark, sf_dir):
    t = Tables(spark, sf_dir)
    flights, failures = _states(spark, sf_dir)
    summary = states.gold_table("ops_summary", flights, failures, t.silver("weather"), t.silver("airports"))
    counts = states.scope(flights, failures) | {"gold_ops_summary": summary.agg(F.count("*").alias("row_count"))}
    columns = {
        "flights": len(t.silver("flights").columns),
        "cancelled_all": len(t.silver("cancelled").columns),
        "cancelled_window": len(t.silver("cancelled").columns),
        "union": len(_operations(spark, sf_dir).columns),
        "gold_ops_summary": len(summary.columns),
    }
    rows_of = [df.select(F.lit(n).alias("table_name"), "row_count", F.lit(columns[n]).alias("column_count")) for n, df in counts.items()]
    return reduce(DataFrame.unionAll, rows_of)


# --- silver and gold tables ---------------------------------------------------------------------


def _silver_query(name: str) -> Query:
    return lambda spark, sf_dir: _stamped(Tables(spark, sf_dir).silver(name))


def _gold_query(name: str) -> Query:
    return lambda spark, sf_dir: Tables(spark, sf_dir).gold(name)


for _name in silver.SILVER:
    QUERIES[f"silver_{_name}"] = _silver_query(_name)
for _name in medallion.GOLD:
    QUERIES[f"gold_{_name}"] = _gold_query(_name)


def _merged_gold_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = Tables(spark, sf_dir)
        return states.gold_table(name, *_states(spark, sf_dir, by_month=True), t.silver("weather"), t.silver("airports"))

    return run


for _name in medallion.GOLD:
    QUERIES[f"merged_{_name}"] = _merged_gold_query(_name)


@query
def gold_ops_summary_aligned(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cancelled = t.silver("cancelled", distance_standard="short")
    return gold.ops_summary(t.silver("flights"), cancelled, t.silver("airports"))


def _medallion(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    base = scratch_dir(spark)
    for name, file in fixed.RAW_FILES.items():
        write_raw_csv(raw(spark, sf_dir, name), f"{base}/raw/{file}")
    return base, medallion.build_all(spark, f"{base}/raw", base)


@query
def medallion_tables(spark, sf_dir):
    return _medallion(spark, sf_dir)[1]


@query
def medallion_gold(spark, sf_dir):
    base, _ = _medallion(spark, sf_dir)
    table = files.read_table(spark, files.table_path(f"{base}/gold", "weather_delay_impact"))
    return table.select(*Tables(spark, sf_dir).gold("weather_delay_impact").columns)


# --- reports ------------------------------------------------------------------------------------

FREQUENCY_REPORTS = {
    "r1_departure_status": ("flights", "departure_status", False),
    "r2_arrival_status": ("flights", "arrival_status", False),
    "r3_primary_cause": ("flights", "primary_delay_cause", True),
    "r4_distance_flights": ("flights", "distance_type", False),
    "r5_flight_status": ("cancelled", "flight_status", False),
    "r6_distance_cancelled": ("cancelled", "distance_type", False),
    "r9_season": ("weather", "weather_season", False),
    "r10_wind": ("weather", "wind_category", False),
    "r11_pressure": ("weather", "pressure_category", False),
    "r12_precip": ("weather", "is_precipitation", False),
    "r13_region": ("airports", "us_region", False),
    "r14_alaska_hawaii": ("airports", "is_alaska_hawaii", False),
}


def _frequency_query(table: str, col: str, by_count: bool) -> Query:
    return lambda spark, sf_dir: rows.frequency(Tables(spark, sf_dir).silver(table), col, by_count)


for _name, _spec in FREQUENCY_REPORTS.items():
    QUERIES[_name] = _frequency_query(*_spec)


@query
def r7_cause_diverted(spark, sf_dir):
    return reports.diverted_causes(Tables(spark, sf_dir).silver("cancelled"))


@query
def r8_delay_nulls_by_status(spark, sf_dir):
    return reports.delay_nulls_by_status(Tables(spark, sf_dir).silver("cancelled"))


@query
def r15_top_routes(spark, sf_dir):
    return reports.top_routes(Tables(spark, sf_dir).gold("flight_performance"), gold.ROUTE_KEYS)


@query
def r25_status_split(spark, sf_dir):
    return reports.status_split(_operations(spark, sf_dir))


@query
def r30_worst_routes(spark, sf_dir):
    summary = Tables(spark, sf_dir).gold("ops_summary")
    return reports.worst_routes(summary, [*gold.ROUTE_KEYS, "weekday_name"], WORST_ROUTE_MIN_SCHEDULED)


GOLD_REPORT_QUERIES = {
    "r16": "ontime_by_airline", "r17": "perf_by_region",
    "r18": "delay_by_wind", "r19": "delay_by_pressure", "r20": "delay_by_precip",
    "r21": "cancel_by_airline", "r22": "cancel_by_month", "r23": "cancel_by_region", "r24": "cancel_by_weekday",
    "r26": "ops_by_airline", "r27": "ops_by_month", "r28": "ops_by_region", "r29": "ops_by_weekday",
    "r31": "wx_cancel_by_wind", "r32": "wx_cancel_by_pressure", "r33": "wx_cancel_by_precip",
    "r34": "wx_cancel_by_season", "r35": "wx_cancel_by_region",
}


def _gold_report_query(report: str) -> Query:
    table = reports.GOLD_REPORTS[report].gold
    return lambda spark, sf_dir: reports.gold_report(Tables(spark, sf_dir).gold(table), report)


for _id, _name in GOLD_REPORT_QUERIES.items():
    QUERIES[f"{_id}_{_name}"] = _gold_report_query(_name)


@query
def weighted_cancel_by_region(spark, sf_dir):
    return reports.gold_report(Tables(spark, sf_dir).gold("cancellation_analysis"), "cancel_by_region", weighted=True)
