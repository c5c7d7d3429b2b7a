"""Every registered query against its DuckDB statement: columns, types, rows."""

import pytest

import __spark_entry__ as entry_point
from harness.oracle import ORACLE_SQL as ORACLE
from harness.queries import QUERIES

DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == SKETCHED
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


# Estimates, which SQL cannot state.
SKETCHED = {"q1_profile_sketch"}


def test_sketched_profile_of_flights(spark, sf_dir):
    exact = {r.column_name: r for r in QUERIES["q1_profile_columns"](spark, sf_dir).collect()}
    got = QUERIES["q1_profile_sketch"](spark, sf_dir).collect()
    assert len(got) == len(exact)
    for r in got:
        assert (r.dtype, r.null_count) == (exact[r.column_name].dtype, exact[r.column_name].null_count)
        assert abs(r.distinct_count - exact[r.column_name].distinct_count) <= 0.03 * exact[r.column_name].distinct_count


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKETCHED))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    duck_types = {d[0]: str(d[1]) for d in result.description}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == duck_types

    spark_order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    names = [d[0] for d in result.description]
    duck_order = sorted(range(len(names)), key=lambda i: names[i])
    got = sorted((tuple(r[i] for i in spark_order) for r in df.collect()), key=repr)
    want = sorted((tuple(r[i] for i in duck_order) for r in result.fetchall()), key=repr)
    assert got
    assert got == want


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


# report -> order of its rows; the comparison above sorts both sides
ROW_ORDER = {
    "r1_departure_status": "departure_status NULLS FIRST",
    "r13_region": "us_region NULLS FIRST",
    "r3_primary_cause": "count DESC, primary_delay_cause NULLS FIRST",
    "r16_ontime_by_airline": "avg_on_time_pct DESC NULLS LAST, airline NULLS FIRST",
    "r22_cancel_by_month": "flight_month NULLS FIRST",
    "r26_ops_by_airline": "cancel_rate_pct NULLS FIRST, airline NULLS FIRST",
    "r27_ops_by_month": "flight_month NULLS FIRST",
    "r31_wx_cancel_by_wind": "cancel_rate_pct DESC NULLS LAST, wind_category NULLS FIRST",
}


@pytest.mark.parametrize("name", sorted(ROW_ORDER))
def test_report_rows_are_in_order(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    key = df.columns[0]
    want = duck.execute(f"SELECT {key} FROM ({ORACLE[name]}) ORDER BY {ROW_ORDER[name]}").fetchall()
    assert [r[key] for r in df.collect()] == [r[0] for r in want]


def test_inputs_grow_with_the_tables(spark, sf_dir):
    from harness.fixtures import raw

    airports = raw(spark, sf_dir, "airports")
    assert airports.count() == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    larger = {n: raw(spark, "/root/testdata/sf0.01", n) for n in ("weather", "flights")}
    assert larger["weather"].count() > 5 * raw(spark, sf_dir, "weather").count()
    assert larger["flights"].select("Airline").distinct().count() > 15
