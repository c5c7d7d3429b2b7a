"""Column rules on literal rows: NULLs, limits, ties and unknown values."""

import itertools
from datetime import date

import pytest
from pyspark.sql import functions as F

from aeroledger.functions import dates, delays, labels, measures
from aeroledger.functions import fixed_values as fixed
from aeroledger.operators.summarize import aggregate, averaged, averaged_over, combine, largest
from aeroledger.operators import rows, shaping

CAUSES = list(fixed.DELAY_CAUSES.values())
NAMES = list(fixed.DELAY_CAUSES)


def values(spark, schema, data, column):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(column).collect()]


def one(spark, dtype, data, make):
    return values(spark, f"x {dtype}", [(v,) for v in data], make("x"))


def test_fix_label(spark):
    got = one(spark, "string", ["Hight >60min", "hight x HIGHT", "High", "Low", None], labels.fix_label)
    assert got == ["High >60min", "High x High", "High", "Low", None]


def test_map_labels_passes_unknown_and_null(spark):
    got = one(
        spark, "string", ["Short Haul >1500Mi", "Short Haul", "Ultra", " Long Haul <6000Mi", None],
        lambda c: labels.map_labels(c, fixed.SHORT_DISTANCE_LABELS),
    )
    assert got == ["Short Haul", "Short Haul", "Ultra", " Long Haul <6000Mi", None]


def test_distance_maps_are_inverse():
    assert {v: k for k, v in fixed.SHORT_DISTANCE_LABELS.items()} == fixed.LONG_DISTANCE_LABELS


def test_delay_status(spark):
    assert one(spark, "int", [-1, 0, 1, None], labels.delay_status) == ["Early", "On Time", "Delayed", None]


def test_weekday_from_int(spark):
    got = one(spark, "int", [1, 7, 0, 8, -1, None], labels.weekday_from_int)
    assert got == ["Monday", "Sunday", None, None, None, None]


def test_flight_status(spark):
    data = [(1, 1), (1, 0), (0, 1), (0, 0), (None, 1), (None, None), (0, None), (2, 2)]
    got = values(spark, "c int, d int", data, labels.flight_status("c", "d"))
    assert got == ["Cancelled", "Cancelled", "Diverted", "Completed", "Diverted", "Completed", "Completed", "Completed"]


def test_season(spark):
    got = one(spark, "int", [12, 1, 2, 3, 5, 6, 8, 9, 11, 0, 13, None], labels.season)
    assert got == ["Winter"] * 3 + ["Spring"] * 2 + ["Summer"] * 2 + ["Fall"] * 2 + [None] * 3


def test_wind_bucket(spark):
    got = one(
        spark, "double", [0.0, -3.0, 0.1, 20.0, 20.1, 40.0, 60.0, 60.1, None],
        lambda c: labels.bucket(c, fixed.WIND_STEPS, fixed.WIND_ABOVE),
    )
    assert got == ["Calm", "Light", "Light", "Light", "Moderate", "Moderate", "Strong", "Severe", None]


def test_pressure_bucket(spark):
    got = one(
        spark, "double", [999.9, 1000.0, 1020.0, 1020.1, None],
        lambda c: labels.bucket(c, fixed.PRESSURE_STEPS, fixed.PRESSURE_ABOVE),
    )
    assert got == ["Low", "Normal", "Normal", "High", None]


def test_region_and_outliers(spark):
    states = ["NY", "GA", "OH", "TX", "CA", "AK", "HI", "DC", "PR", "ny", None]
    got = one(spark, "string", states, lambda c: labels.group_of(c, fixed.REGION_STATES))
    assert got == ["Northeast", "Southeast", "Midwest", "Southwest", "West", "Pacific", "Pacific"] + [None] * 4
    got = one(spark, "string", states, lambda c: labels.is_in(c, fixed.ALASKA_HAWAII))
    assert got == [s in ("AK", "HI") for s in states]


def test_states_have_one_region():
    states = [s for group in fixed.REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 50


def test_parse_date(spark):
    got = one(
        spark, "string", ["05-01-2023", "31-02-2023", "2023-01-05", "x", "", None],
        lambda c: dates.parse_date(c, fixed.FLIGHT_DATE_FORMAT),
    )
    assert got == [date(2023, 1, 5), None, None, None, None, None]


def test_date_parts_and_weekday(spark):
    df = spark.createDataFrame([(date(2023, 1, 1),), (date(2024, 2, 29),), (None,)], "d date")
    df = df.withColumns(dates.date_parts("d", "Flight")).withColumn("w", dates.weekday_name("d"))
    assert [t for _, t in df.dtypes] == ["date", "int", "int", "int", "string"]
    assert [tuple(r)[1:] for r in df.collect()] == [
        (2023, 1, 1, "Sunday"), (2024, 2, 29, "Thursday"), (None, None, None, None)
    ]


def test_numbers(spark):
    data = [(1.0, 3.25), (None, 1.0), (2.0, None), (1.0, 1.05), (-1.5, 2.0)]
    got = values(spark, "lo double, hi double", data, measures.temp_range("lo", "hi"))
    assert got == [2.3, None, None, 0.1, 3.5]
    assert one(spark, "double", [0.0, 0.1, -1.0, None], measures.positive_flag) == [False, True, False, None]


MINUTES = list(itertools.product([None, 0, 1, 2], repeat=5))


def expected_total(row):
    return None if all(v is None for v in row) else sum(v or 0 for v in row)


def expected_cause(row, total, nulls_as_zero=False):
    """The cascade on Python values; a comparison with None does not hold."""
    if total is None:
        return None
    if total == 0:
        return "None"
    if nulls_as_zero:
        row = [v or 0 for v in row]
    for i in range(4):
        rest = row[i + 1 :]
        if row[i] is not None and all(v is not None and row[i] >= v for v in rest):
            return NAMES[i]
    return NAMES[4]


@pytest.fixture(scope="module")
def minutes(spark):
    return spark.createDataFrame(MINUTES, ", ".join(f"{c} int" for c in CAUSES))


@pytest.mark.parametrize("nulls_as_zero", [False, True])
def test_total_and_cause_of_every_pattern(minutes, nulls_as_zero):
    df = minutes.withColumn("total", delays.sum_or_null(CAUSES))
    df = df.withColumn("cause", delays.argmax_label(fixed.DELAY_CAUSES, "total", nulls_as_zero=nulls_as_zero))
    got = df.collect()
    assert len(got) == len(MINUTES)
    for r in got:
        row = tuple(r)[:5]
        assert r.total == expected_total(row)
        assert r.cause == expected_cause(row, r.total, nulls_as_zero), row


def test_null_operand_moves_the_cause_on(spark):
    df = spark.createDataFrame([(10, None, 0, 0, 0)], ", ".join(f"{c} int" for c in CAUSES))
    df = df.withColumn("total", delays.sum_or_null(CAUSES))
    exact = delays.argmax_label(fixed.DELAY_CAUSES, "total")
    zero = delays.argmax_label(fixed.DELAY_CAUSES, "total", nulls_as_zero=True)
    assert tuple(df.select("total", exact, zero).first()) == (10, "NAS", "Carrier")


def test_guarded_total_and_cause(minutes):
    flags = minutes.withColumn("flag", F.explode(F.array(F.lit(0), F.lit(1), F.lit(None).cast("int"))))
    guard = "flag = 1"
    df = flags.withColumn("total", delays.sum_unless(CAUSES, guard))
    df = df.withColumn("cause", delays.argmax_label(fixed.DELAY_CAUSES, "total", blank_when=guard))
    for r in df.collect():
        row = tuple(r)[:5]
        total = None if r.flag == 1 else sum(v or 0 for v in row)
        assert r.total == total
        assert r.cause == (None if r.flag == 1 else expected_cause(row, total))


def test_nullify_keeps_types_and_null_flags(spark):
    df = spark.createDataFrame([(1, 5, "a"), (0, 6, "b"), (None, 7, "c")], "flag int, x int, y string")
    got = shaping.nullify(df, ["x", "y"], F.col("flag") == 1)
    assert got.dtypes == df.dtypes
    assert [tuple(r) for r in got.collect()] == [(1, None, None), (0, 6, "b"), (None, 7, "c")]


def test_trim_upper_rename_fill(spark):
    df = spark.createDataFrame([(" a ", " b ", 1, None)], "x string, y string, n int, z double")
    assert tuple(shaping.trim_strings(df, exclude=["y"]).first()) == ("a", " b ", 1, None)
    assert tuple(shaping.upper_cols(df, ["x"]).first()) == (" A ", " b ", 1, None)
    assert shaping.rename(df, {"X": "Xx", "absent": "q"}).columns == ["Xx", "y", "n", "z"]
    assert shaping.lower_columns(shaping.rename(df, {"x": "ABC"})).columns == ["abc", "y", "n", "z"]
    assert shaping.fill(df, {"z": 0.0}).first().z == 0.0
    assert tuple(shaping.tag(df, ["n"], "s", "Completed").first()) == (1, "Completed")
    assert shaping.conform(df, ["n", "x"]).columns == ["n", "x"]
    assert one(spark, "string", [" ab ", None], labels.normalize_key) == ["AB", None]


def test_load_timestamp_is_one_value(spark):
    df = shaping.add_load_ts(spark.range(100, numPartitions=4))
    assert df.select("Silver_Load_Timestamp").distinct().count() == 1


def test_dedup_is_exact_and_idempotent(spark):
    data = [(" a", None, 0.0), (" a", None, 0.0), ("a", None, 0.0), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(data, "x string, y int, z double")
    once = rows.drop_copies(df)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(set(data), key=repr)
    assert rows.drop_copies(once).count() == once.count()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1), (None, 2)], "k string, v int")
    assert sorted(map(tuple, rows.duplicate_keys(df, ["k"]).collect()), key=repr) == [("A", 2), (None, 2)]


def test_rates_and_means(spark):
    df = spark.createDataFrame([(1, 3), (0, None), (None, 4), (1, 4)], "f int, v int")
    found = [averaged("a", "int(f = 1)", 1, percent=True), averaged("b", "v", 1), largest("c", "v")]
    assert [tuple(r) for r in aggregate(df.withColumn("k", F.lit(1)), ["k"], found).collect()] == [(1, 66.7, 3.7, 4)]
    nulls = df.select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("f"), F.lit(None).cast("int").alias("v"))
    assert [tuple(r) for r in aggregate(nulls, ["k"], found).collect()] == [(1, None, None, None)]


def test_means_over_facts_do_not_depend_on_the_order(spark):
    data = [(k, (7 * k * i % 391) / 10, 1 + (k + i) % 3) for k in range(1000) for i in range(1, 5)]
    df = spark.createDataFrame(data, "k int, x double, facts long").coalesce(1)
    mean = [averaged_over("m", "x", "facts", 1)]
    up = combine(df.sortWithinPartitions("k", "x"), ["k"], mean)
    down = combine(df.sortWithinPartitions(F.desc("k"), F.desc("x")), ["k"], mean)
    assert sorted(map(tuple, up.collect())) == sorted(map(tuple, down.collect()))


def test_exact_mean_rounds_decimal_ties_up_in_any_order(spark):
    data = [(0.1,), (0.2,), (0.15,), (None,), (0.35,)]  # mean 0.2
    df = spark.createDataFrame(data, "x double")
    assert df.agg(measures.exact_mean("x", 1)).first()[0] == 0.2
    ties = spark.createDataFrame([(1.1,), (1.2,)], "x double").agg(measures.exact_mean("x", 1)).first()[0]
    assert ties == 1.2  # 1.15 rounds half up
    weighted = spark.createDataFrame([(1.0, 3), (2.0, 1), (None, 9)], "x double, n bigint")
    assert weighted.agg(measures.exact_mean("x", 2, weight="n")).first()[0] == 1.25
