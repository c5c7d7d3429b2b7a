"""Invariants of the tables, and summaries against a plain join-then-aggregate."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aeroledger.functions import fixed_values as fixed
from aeroledger.operators import joins, rows
from aeroledger.plans import gold, medallion, reports, silver
from conftest import ordered
from harness.queries import Tables


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir)


@pytest.fixture(scope="module")
def written(spark, tables, tmp_path_factory):
    """Silver tables as parquet, so that each test does not derive them again."""
    base = tmp_path_factory.mktemp("silver")
    out = {}
    for name in silver.SILVER:
        tables.silver(name).write.parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return out


@pytest.mark.parametrize("name", sorted(silver.SILVER))
def test_silver_contract(tables, name):
    df = tables.silver(name)
    want = StructType.fromDDL(fixed.SILVER_SCHEMAS[name])
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in want]
    assert {"flights": 33, "cancelled": 31, "weather": 19, "airports": 10}[name] == len(df.columns)
    assert df.filter("silver_load_timestamp IS NULL").count() == 0


def test_gold_column_counts(tables):
    counts = {name: len(tables.gold(name).columns) for name in medallion.GOLD}
    assert counts == {
        "flight_performance": 22,
        "weather_delay_impact": 17,
        "cancellation_analysis": 18,
        "weather_cancellation": 18,
        "ops_summary": 23,
    }


def test_unique_dimensions_keep_fact_rows(written):
    flights = written["flights"]
    assert rows.duplicate_keys(written["airports"], ["iata_code"]).count() == 0
    assert rows.duplicate_keys(written["weather"], ["iata_code", "weather_date"]).count() == 0
    assert joins.with_airport(flights, written["airports"]).count() == flights.count()
    assert joins.with_weather(flights, written["weather"]).count() == flights.count()


def test_totals_add_up(written):
    f, c, w, a = (written[n] for n in ("flights", "cancelled", "weather", "airports"))
    performance = gold.flight_performance(f, a)
    assert performance.agg(F.sum("total_flights")).first()[0] == f.count()
    odd = performance.filter("abs(on_time_pct + delayed_pct - 100) > 0.11 OR (on_time_pct IS NULL) != (delayed_pct IS NULL)")
    assert odd.count() == 0

    summary = gold.ops_summary(f, c, a)
    assert summary.filter("completed_count + cancelled_count + diverted_count < total_scheduled").count() == 0
    window = rows.in_months(c, fixed.OPERATION_MONTHS)
    assert summary.agg(F.sum("total_scheduled")).first()[0] == f.count() + window.count()

    impact = gold.weather_delay_impact(f, w, a)
    assert impact.agg(F.sum("total_flights")).first()[0] == f.count()


def test_cancelled_rows_are_blank(written):
    blank = [c.lower() for c in fixed.BLANK_WHEN_CANCELLED] + ["total_delay_minutes", "primary_delay_cause"]
    failed = written["cancelled"].filter("cancelled = 1")
    assert failed.count() > 0
    assert failed.filter(F.coalesce(*[F.col(c).cast("string") for c in blank]).isNotNull()).count() == 0


def test_aligned_labels_merge_groups(written):
    assert set(r[0] for r in written["cancelled"].select("distance_type").distinct().collect()) == {
        "Short Haul >1500Mi", "Medium Haul <3000Mi", "Long Haul <6000Mi", "Ultra"
    }
    with pytest.raises(ValueError):
        silver.clean_cancelled(written["cancelled"], distance_standard="other")


# --- summaries with keys that repeat, are missing or are NULL --------------------------

FLIGHT_SCHEMA = """flightdate date, flight_year int, flight_month int, weekday_name string, airline string,
  dep_airport string, arr_airport string, arr_cityname string, distance_type string,
  dep_delay int, arr_delay int, flight_duration int, total_delay_minutes int, primary_delay_cause string,
  cancelled int, diverted int, flight_status string"""


@pytest.fixture(scope="module")
def small(spark):
    """Facts where one airport holds most rows, with dimensions that repeat keys."""
    facts = spark.range(3000).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL ELSE date_add(date'2023-01-30', int(id % 4)) END AS flightdate",
        "CASE WHEN id % 3 < 2 THEN 'HOT' WHEN id % 13 = 0 THEN NULL ELSE concat('K', id % 5) END AS dep_airport",
        "concat('L', id % 2) AS airline", "concat('R', id % 3) AS arr_airport", "'c' AS arr_cityname",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE 'Short Haul' END AS distance_type",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE int(id % 9) - 4 END AS dep_delay",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE int(id % 8) - 4 END AS arr_delay",
        "int(id % 100) AS flight_duration", "CASE WHEN id % 6 = 0 THEN NULL ELSE int(id % 10) END AS total_delay_minutes",
        "element_at(array('Carrier','Weather','NAS','LastAircraft','Security','None',NULL), int(id % 7) + 1) AS primary_delay_cause",
        "CASE WHEN id % 17 = 0 THEN NULL ELSE int(id % 2) END AS cancelled", "int(id % 3 = 0) AS diverted",
        "element_at(array('Completed','Cancelled','Diverted'), int(id % 3) + 1) AS flight_status",
    ).selectExpr("*", "year(flightdate) AS flight_year", "month(flightdate) AS flight_month",
                 "date_format(flightdate, 'EEEE') AS weekday_name")
    airports = spark.createDataFrame(
        [("HOT", "x", "NY", "Northeast"), ("HOT", "x", "NY", "Northeast"), ("HOT", "y", "GA", "Southeast"),
         ("K1", "z", None, None), ("K2", "z", "TX", "Southwest"), (None, "n", "CA", "West"), ("ZZ", "u", "CA", "West")],
        "iata_code string, city string, state string, us_region string",
    )
    weather = spark.sql("""
      SELECT a.code AS iata_code, date_add(date'2023-01-30', d.i) AS weather_date, 'Winter' AS weather_season,
        element_at(array('Calm','Light',NULL), d.i % 3 + 1) AS wind_category, 'Low' AS pressure_category,
        d.i % 2 = 0 AS is_precipitation, d.i * 0.5D AS temp_avg_c,
        CASE WHEN d.i = 1 THEN NULL ELSE 2.25D END AS temp_range_c, CASE WHEN d.i = 2 THEN NULL ELSE 10.5D * d.i END AS wind_speed_kmh,
        CASE WHEN d.i = 0 THEN NULL ELSE 0.25D * d.i END AS precipitation_mm, 0D AS snowfall_mm
      FROM VALUES ('HOT'), ('HOT'), ('K1'), (NULL) AS a(code) LATERAL VIEW explode(array(0,1,2)) d AS i""")
    return facts, weather, airports


def by_row(df):
    """Rows with columns in name order."""
    return ordered(df.select(*sorted(df.columns)))


def plain(joined, keys, **outputs):
    return joined.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in outputs.items()])


SKY_MEANS = {
    "avg_temp_c": "round(avg(temp_avg_c), 1)",
    "avg_temp_range_c": "round(avg(temp_range_c), 1)",
    "avg_wind_speed_kmh": "round(avg(wind_speed_kmh), 1)",
    "avg_precipitation_mm": "round(avg(precipitation_mm), 2)",
    "avg_snowfall_mm": "round(avg(snowfall_mm), 2)",
}


def test_flight_performance_with_repeated_airports(small):
    facts, _, airports = small
    want = plain(
        joins.with_airport(facts, airports), gold.ROUTE_KEYS,
        total_flights="count(*)", avg_dep_delay_min="round(avg(dep_delay), 1)",
        avg_arr_delay_min="round(avg(arr_delay), 1)", max_dep_delay_min="max(dep_delay)",
        avg_flight_duration_min="round(avg(flight_duration), 1)", avg_total_delay_min="round(avg(total_delay_minutes), 1)",
        on_time_pct="round(avg(int(dep_delay <= 0)) * 100, 1)", delayed_pct="round(avg(int(dep_delay > 0)) * 100, 1)",
        carrier_delay_pct="round(avg(int(primary_delay_cause = 'Carrier')) * 100, 1)",
        weather_delay_pct="round(avg(int(primary_delay_cause = 'Weather')) * 100, 1)",
        nas_delay_pct="round(avg(int(primary_delay_cause = 'NAS')) * 100, 1)",
        aircraft_delay_pct="round(avg(int(primary_delay_cause = 'LastAircraft')) * 100, 1)",
    )
    got = gold.flight_performance(facts, airports)
    assert got.agg(F.sum("total_flights")).first()[0] > facts.count()
    assert by_row(got) == by_row(want)


def test_weather_delay_impact_with_repeated_weather(small):
    facts, weather, airports = small
    joined = joins.with_airport(joins.with_weather(facts, weather), airports, columns=["us_region"])
    want = plain(
        joined, gold.SKY_KEYS,
        total_flights="count(*)", flights_with_weather="sum(int(wind_category IS NOT NULL))",
        weather_match_pct="round(avg(int(wind_category IS NOT NULL)) * 100, 1)",
        avg_dep_delay_min="round(avg(dep_delay), 1)", avg_arr_delay_min="round(avg(arr_delay), 1)",
        delayed_flight_pct="round(avg(int(dep_delay > 0)) * 100, 1)",
        avg_total_delay_min="round(avg(total_delay_minutes), 1)", **SKY_MEANS,
    )
    assert by_row(gold.weather_delay_impact(facts, weather, airports)) == by_row(want)


FAILURES = {
    "total_events": "count(*)", "cancelled_count": "sum(int(cancelled = 1))", "diverted_count": "sum(int(diverted = 1))",
    "cancellation_rate_pct": "round(avg(int(cancelled = 1)) * 100, 2)",
    "diversion_rate_pct": "round(avg(int(diverted = 1)) * 100, 2)",
}


def test_cancellation_analysis_with_repeated_airports(small):
    facts, _, airports = small
    want = plain(
        joins.with_airport(facts, airports), [*gold.ROUTE_KEYS, "weekday_name"], **FAILURES,
        diverted_avg_dep_delay_min="round(avg(CASE WHEN diverted = 1 THEN dep_delay END), 1)",
        diverted_max_dep_delay_min="max(CASE WHEN diverted = 1 THEN dep_delay END)",
    )
    assert by_row(gold.cancellation_analysis(facts, airports)) == by_row(want)


def test_weather_cancellation_with_repeated_weather(small):
    facts, weather, airports = small
    joined = joins.with_airport(joins.with_weather(facts, weather), airports, columns=["us_region"])
    want = plain(
        joined, [*gold.SKY_KEYS, "flight_month"], **FAILURES, **SKY_MEANS,
        events_with_weather="sum(int(wind_category IS NOT NULL))",
        weather_match_pct="round(avg(int(wind_category IS NOT NULL)) * 100, 1)",
    )
    assert by_row(gold.weather_cancellation(facts, weather, airports)) == by_row(want)


def test_coverage_counts_joined_rows(small):
    facts, weather, airports = small
    joined = joins.with_airport(joins.with_weather(facts, weather), airports, columns=["us_region"])
    total, matched = joined.agg(F.count("*"), F.count("wind_category")).first()
    got = gold.weather_coverage(facts, weather, airports).first()
    assert tuple(got)[:3] == (total, matched, total - matched)
    empty = gold.weather_coverage(facts.filter("airline = '?'"), weather, airports).first()
    assert tuple(empty) == (0, 0, 0, 0.0)
    monthly = gold.weather_coverage(facts, weather, airports, by=["flight_month"])
    assert monthly.agg(F.sum("total")).first()[0] == total


# --- reports ------------------------------------------------------------------------------


def test_ranking_breaks_ties_by_key_and_puts_nulls_last(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0), (None, 1.0)], "k string, m double")
    assert [r.k for r in reports.ranked(df, "m", ["k"]).collect()] == ["d", None, "a", "b", "c"]
    assert [r.k for r in reports.ranked(df, "m", ["k"], limit=2).collect()] == ["d", None]
    assert [r.k for r in reports.ranked(df, "m", ["k"], ascending=True).collect()] == ["c", None, "a", "b", "d"]


def test_weighted_report(spark):
    groups = spark.createDataFrame([("L", 10.0, 1), ("L", 20.0, 3), ("L", None, 5)], "airline string, on_time_pct double, total_flights bigint")
    assert reports.gold_report(groups, "ontime_by_airline").first().avg_on_time_pct == 15.0
    assert reports.gold_report(groups, "ontime_by_airline", weighted=True).first().avg_on_time_pct == 17.5


def test_worst_routes_threshold(tables):
    summary = tables.gold("ops_summary")
    got = reports.worst_routes(summary, gold.ROUTE_KEYS, min_scheduled=2)
    assert len(got.columns) == 7 and 0 < got.count() <= 10
    assert got.filter("total_scheduled < 2").count() == 0


def test_reports_keep_every_group_unless_asked(spark):
    months = [(m, 10, 4, 40.0) for m in [None, *range(1, 13)]]
    schema = "flight_month int, total_events bigint, cancelled_count bigint, cancellation_rate_pct double"
    gold = spark.createDataFrame(months, schema)
    assert [r.flight_month for r in reports.gold_report(gold, "cancel_by_month").collect()] == [None, *range(1, 13)]
    assert reports.gold_report(gold, "cancel_by_month", limit=5).count() == 5
    airlines = gold.select(F.concat(F.lit("a"), F.col("flight_month")).alias("airline"), *gold.columns[1:])
    many = airlines.unionByName(airlines.withColumn("airline", F.concat(F.lit("b"), "airline")))
    assert reports.gold_report(many, "cancel_by_airline").count() == 25
