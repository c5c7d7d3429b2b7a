"""Profiles against counts made in Python."""

from datetime import datetime

import pytest

from aeroledger.operators import profiling
from conftest import final_plan, ordered

SCHEMA = "a int, b string, c double, d bigint, t timestamp, `odd.name` int, e int"
DATA = [
    (1, "x", 0.0, 2**53 + 1, datetime(2023, 10, 29, 0, 30), 1, None),
    (1, None, -0.0, 2**53, datetime(2023, 10, 29, 1, 30), 2, None),
    (None, "y", None, None, None, 3, None),
    (2, "", 1.5, 2**53 + 1, datetime(2023, 10, 29, 0, 30), 4, None),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_profile_columns(df):
    assert ordered(profiling.profile_columns(df)) == sorted(
        [("a", "int", 1, 3), ("b", "string", 1, 4), ("c", "double", 1, 3), ("d", "bigint", 1, 3),
         ("t", "timestamp", 1, 3), ("odd.name", "int", 0, 4), ("e", "int", 4, 1)],
        key=repr,
    )


def test_repeated_hour_is_two_values(df, conf):
    conf({"spark.sql.session.timeZone": "Europe/Berlin"})
    counts = {r.column_name: r.distinct_count for r in profiling.profile_columns(df).collect()}
    assert counts["t"] == 3


def test_profile_numeric(df):
    got = {r.column_name: tuple(r)[1:] for r in profiling.profile_numeric(df).collect()}
    assert set(got) == {"a", "c", "d", "odd.name", "e"}
    assert got["a"] == ("1", "2", 1.33)
    assert got["d"][:2] == (str(2**53), str(2**53 + 1))
    assert got["e"] == (None, None, None)


def test_low_cardinality(df):
    got = ordered(profiling.low_cardinality(df, k=4).filter("column_name IN ('a', 'b', 'e')"))
    assert got == sorted([("a", "1"), ("a", "2"), ("a", None), ("e", None)], key=repr)


def test_low_cardinality_at_the_limit(spark):
    rows = [(i, i % 7, i % 8, None if i % 7 == 6 else str(i % 7), "" if i % 2 else None, i % 6 / 2) for i in range(5_000)]
    df = spark.createDataFrame(rows, "many int, seven int, eight int, with_null string, blank string, half double").repartition(7)
    got = profiling.low_cardinality(df, k=8)
    want = [("seven", str(i)) for i in range(7)] + [("with_null", None), *(("with_null", str(i)) for i in range(6))]
    want += [("blank", ""), ("blank", None), *(("half", str(i / 2)) for i in range(6))]
    assert ordered(got) == sorted(want, key=repr)
    for k in (2, 3, 7, 300, 6_000):
        counts = {r.column_name: r.distinct_count for r in profiling.profile_columns(df).collect()}
        assert {r.column_name for r in profiling.low_cardinality(df, k=k).collect()} == {c for c, n in counts.items() if n < k}
    assert profiling.low_cardinality(df.limit(0)).count() == 0


def test_low_cardinality_counts_values_of_narrow_columns_only(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "cast(id % 3 AS string) AS few", "uuid() AS wide").write.parquet(f"{tmp_path}/t")
    plan = final_plan(profiling.low_cardinality(spark.read.parquet(f"{tmp_path}/t")))
    assert plan.count("FileScan") == 1 and "wide" not in plan and "id#" not in plan
    assert {r.column_name for r in profiling.low_cardinality(spark.read.parquet(f"{tmp_path}/t")).collect()} == {"few"}


def test_sketched_profile(spark, df):
    rows = [(i, i % 900, None if i % 5 == 0 else f"v{i % 20_000}", "", None, i / 8) for i in range(60_000)]
    big = spark.createDataFrame(rows, "a int, b bigint, c string, d string, e string, f double").repartition(6)
    exact = {r.column_name: r for r in profiling.profile_columns(big).collect()}
    whole = profiling.sketch_columns(big)
    parts = profiling.sketch_columns(big.filter("a < 1000")).unionByName(profiling.sketch_columns(big.filter("a >= 1000")))
    for sketches in (whole, profiling.merge_sketches(parts)):
        got = {r.column_name: r for r in profiling.profile_sketches(sketches).collect()}
        assert got.keys() == exact.keys()
        for c, r in got.items():
            assert (r.dtype, r.null_count) == (exact[c].dtype, exact[c].null_count)
            assert abs(r.distinct_count - exact[c].distinct_count) <= 0.03 * exact[c].distinct_count
    assert ordered(profiling.profile_sketches(profiling.sketch_columns(df))) == ordered(profiling.profile_columns(df))
    plan = final_plan(profiling.profile_sketches(profiling.sketch_columns(df)))
    assert "hashpartitioning" not in plan and plan.count("Exchange") == 1


def test_null_counts_and_audit(df):
    assert tuple(profiling.null_counts(df, ["a", "e"]).first()) == (1, 4)
    assert ordered(profiling.audit({"all": df, "few": df.select("a").limit(2)})) == [("all", 4, 7), ("few", 2, 1)]


def test_audit_of_cleaning(df):
    raw = df.union(df.limit(1))
    got = profiling.audit_cleaning(raw, raw.dropDuplicates(), df.select("a")).first()
    assert tuple(got) == (5, 4, 1, 4, 1)


def test_coverage_of_plain_rows(df):
    got = profiling.join_coverage(df, "b").first()
    assert tuple(got) == (4, 3, 1, 75.0)
    assert tuple(profiling.join_coverage(df.filter("a = 99"), "b").first()) == (0, 0, 0, 0.0)
