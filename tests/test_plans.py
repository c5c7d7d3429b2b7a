"""Physical plans: broadcasts, pruning, shuffles and skew."""

import re
from functools import reduce

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aeroledger.functions import fixed_values as fixed
from aeroledger.operators import joins, profiling, rows
from aeroledger.plans import gold, medallion, states
from aeroledger.sources import files
from conftest import final_plan, ordered
from harness.queries import Tables


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake"))
    for name in fixed.RAW_FILES:
        df = Tables(spark, sf_dir).silver(name)
        files.write_table(df, files.table_path(f"{path}/silver", name), fixed.SILVER_PARTITIONS[name])
    return path


@pytest.fixture(scope="module")
def stored(spark, base):
    return {name: medallion.read_silver(spark, base, name) for name in fixed.RAW_FILES}


def shuffles(plan):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange hashpartitioning", plan))


def test_small_airports_are_broadcast(stored):
    plan = final_plan(joins.with_airport(stored["flights"], stored["airports"]))
    assert "BroadcastHashJoin" in plan and shuffles(plan) == 0


def test_derived_airports_are_broadcast_once_their_size_is_known(spark, sf_dir, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "4KB"})  # below the estimate, above the real size
    t = Tables(spark, sf_dir)
    plan = final_plan(joins.with_airport(t.silver("flights"), t.silver("airports")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_airports_are_not_broadcast(stored, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    joined = joins.with_airport(stored["flights"], stored["airports"])
    plan = final_plan(joined)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.count() == stored["flights"].count()


def test_month_filter_prunes_partitions(stored):
    plan = final_plan(rows.in_months(stored["cancelled"], fixed.OPERATION_MONTHS).select("airline"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "flight_month" in filters


def test_ops_summary_prunes_cancelled_months_and_columns(stored):
    plan = final_plan(gold.ops_summary(stored["flights"], stored["cancelled"], stored["airports"]))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    pruned = [s for s in scans if "flight_month" in s[1]]
    assert len(pruned) == 1
    assert all("tail_number" not in columns and "delay_carrier" not in columns for columns, _ in scans)


def test_route_summaries_shuffle_once(stored):
    f, c, a = stored["flights"], stored["cancelled"], stored["airports"]
    for table in (gold.flight_performance(f, a), gold.cancellation_analysis(c, a), gold.ops_summary(f, c, a)):
        plan = final_plan(table)
        assert shuffles(plan) == 1
        assert "partial_count(1)" in plan or "partial_sum" in plan


def test_weather_joins_run_on_reduced_facts(stored, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = final_plan(gold.weather_delay_impact(stored["flights"], stored["weather"], stored["airports"]))
    # The fact aggregate already has the join's partitioning: its only shuffle is the reduced one.
    assert len(re.findall(r"Exchange hashpartitioning\(dep_airport#\d+, flightdate#\d+", plan)) == 1
    below_join = plan[plan.rindex("SortMergeJoin") :]
    assert "partial_count(1)" in below_join


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("hot_key", ["'N00'", "CAST(NULL AS STRING)"])
def test_hot_keys_are_split_in_row_joins(spark, stored, conf, hot_key):
    facts = spark.range(0, 300000, numPartitions=16).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN {hot_key} ELSE concat('N', lpad(id % 25, 2, '0')) END AS dep_airport",
        "CASE WHEN id % 3 = 0 THEN date'1998-01-05' ELSE date_add(date'1995-01-01', int(id % 2000)) END AS flightdate",
        "sha2(string(id), 256) AS payload",
    )
    small = ordered(joins.with_weather(facts, stored["weather"]).groupBy("dep_airport", "wind_category").count())
    conf(HOT)
    joined = joins.with_weather(facts, stored["weather"])
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 300000
    assert ordered(joined.groupBy("dep_airport", "wind_category").count()) == small


def test_hot_airport_is_split_when_airports_are_not_broadcast(spark, stored, conf):
    facts = spark.range(0, 300000, numPartitions=16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'N00' ELSE concat('N', lpad(id % 500, 3, '0')) END AS dep_airport",
        "sha2(string(id), 256) AS payload",
    )
    small = ordered(joins.with_airport(facts, stored["airports"]).groupBy("dep_airport", "dep_region").count())
    conf(HOT)
    joined = joins.with_airport(facts, stored["airports"])
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert ordered(joined.groupBy("dep_airport", "dep_region").count()) == small


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(0, 90000, numPartitions=8).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS a", "'x' AS b")
    plan = final_plan(rows.drop_copies(df))
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("HashAggregate") < exchange < plan.rindex("HashAggregate")
    assert rows.drop_copies(df).count() == 60001


@pytest.mark.parametrize("name", ["flights", "cancelled", "weather"])
def test_silver_build_shuffles_its_table_once(spark, sf_dir, tmp_path, monkeypatch, name):
    twice = Tables(spark, sf_dir).raw(name).unionAll(Tables(spark, sf_dir).raw(name))
    twice.write.parquet(files.table_path(f"{tmp_path}/bronze", name))
    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: [written.append(self._df), write(self, path)])
    counted = medallion.build_silver(spark, name, str(tmp_path))
    assert len(re.findall("Exchange", final_plan(written[0]))) == 1
    silver = medallion.read_silver(spark, str(tmp_path), name).drop("silver_load_timestamp")
    assert ordered(silver) == ordered(Tables(spark, sf_dir).silver(name).drop("silver_load_timestamp"))
    assert (counted.bronze_rows, counted.silver_rows) == (twice.count(), silver.count())


def test_silver_files_follow_months_and_their_size(spark, conf, tmp_path):
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"})
    path = files.table_path(f"{tmp_path}/bronze", "weather")
    hot = "CASE WHEN id % 100 < 98 THEN date'2023-03-05' ELSE date_add(date'2023-01-01', int(id % 365)) END"  # 98 % on a single day
    struct = StructType.fromDDL(fixed.RAW_SCHEMAS["weather"])
    known = {"time": hot, "airport_id": "sha2(string(id), 256)", "tavg": "id % 7 * 0.5e0"}
    df = spark.range(0, 60000, numPartitions=16).selectExpr(*[f"cast({known.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in struct])
    df.unionAll(df.limit(100)).write.parquet(path)
    medallion.build_silver(spark, "weather", str(tmp_path))
    found = medallion.read_silver(spark, str(tmp_path), "weather").withColumn("file", F.input_file_name())
    months = found.groupBy("weather_month").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"))
    found = {r.weather_month: r for r in months.collect()}
    assert sum(r.n for r in found.values()) == 60000 and len(found) == 12
    assert found[3].files > 4 and all(r.files <= 2 for m, r in found.items() if m != 3)


def test_profiles_read_the_table_once(stored):
    assert final_plan(profiling.profile_columns(stored["weather"])).count("FileScan") == 1
    assert final_plan(profiling.profile_numeric(stored["weather"])).count("FileScan") == 1
    low = final_plan(profiling.low_cardinality(stored["weather"]))
    assert low.count("FileScan") == 1 and "ReusedExchange" in low


def test_no_query_uses_python_rows_or_cross_joins(spark, sf_dir):
    t = Tables(spark, sf_dir)
    for name in medallion.GOLD:
        plan = t.gold(name)._jdf.queryExecution().executedPlan().toString()
        for slow in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoop"):
            assert slow not in plan


def test_top_routes_keep_only_the_best_rows_per_task(spark, sf_dir):
    from aeroledger.plans.reports import top_routes

    plan = final_plan(top_routes(Tables(spark, sf_dir).gold("flight_performance"), gold.ROUTE_KEYS))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_derived_inputs_scan_only_the_columns_they_use(spark, sf_dir):
    plan = final_plan(Tables(spark, sf_dir).raw("weather").agg(F.count("*")))
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_states_scan_the_facts_once(stored):
    for make, name in ((states.flight_states, "flights"), (states.failure_states, "cancelled")):
        plan = final_plan(make(stored[name]))
        assert plan.count("FileScan") == 1 and shuffles(plan) == 1


def test_gold_month_by_month(spark, base, stored, tmp_path):
    months = [tuple(r) for r in stored["flights"].unionByName(stored["cancelled"], allowMissingColumns=True).select("flight_year", "flight_month").distinct().collect()]
    assert len(months) > 3 and any(None in m for m in months)
    paths = {}
    for name, make in (("flights", states.flight_states), ("cancelled", states.failure_states)):
        paths[name] = f"{tmp_path}/{name}"
        own = {ym: F.col("flight_year").eqNullSafe(ym[0]) & F.col("flight_month").eqNullSafe(ym[1]) for ym in months}
        first = sorted(months, key=repr)[-3:]
        rest = reduce(lambda a, b: a | b, [own[ym] for ym in months if ym not in first])
        for part in [rest, *[own[ym] for ym in first], own[first[0]]]:  # one of them again
            states.store(make(stored[name].filter(part)), paths[name])
    made = [states.stored(spark, p) for p in paths.values()]
    for name, (build, sources) in medallion.GOLD.items():
        want = build(*[stored[s] for s in sources])
        got = states.gold_table(name, *made, stored["weather"], stored["airports"])
        assert got.dtypes == want.dtypes and ordered(got) == ordered(want), name


def test_update_of_one_month(spark, sf_dir, tmp_path):
    lake = str(tmp_path)
    for name in fixed.RAW_FILES:
        files.replace_table(Tables(spark, sf_dir).silver(name), files.table_path(f"{lake}/silver", name), fixed.SILVER_PARTITIONS[name])
    medallion.update_gold(spark, lake)
    flights = medallion.read_silver(spark, lake, "flights")
    year, month = flights.filter("flight_month = 1").select("flight_year", "flight_month").first()
    more = flights.filter((F.col("flight_year") == year) & (F.col("flight_month") == month)).limit(9)
    files.replace_table(flights.unionByName(more), files.table_path(f"{lake}/silver", "flights"), fixed.SILVER_PARTITIONS["flights"])
    medallion.update_gold(spark, lake, [(year, month)])
    updated = {n: ordered(files.read_table(spark, files.table_path(f"{lake}/gold", n))) for n in medallion.GOLD}
    for name in medallion.GOLD:
        medallion.build_gold(spark, name, lake)
        assert ordered(files.read_table(spark, files.table_path(f"{lake}/gold", name))) == updated[name]


def shuffled_bytes(df):
    """Bytes that the exchanges of a query have written."""
    df.collect()

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName() in ("ShuffleQueryStage", "ResultQueryStage", "BroadcastQueryStage"):
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten") if node.nodeName() == "Exchange" else None
        children = node.children()
        return (own.get().value() if own is not None else 0) + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_few_copies_shuffle_fingerprints(spark, tmp_path):
    wide = [F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 256).alias(f"c{i}") for i in range(12)]
    table = spark.range(20_000, numPartitions=8).select("id", *wide)
    table.unionAll(table.filter("id % 500 = 0")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    few, all_rows = rows.drop_copies(df, few=True), rows.drop_copies(df)
    assert ordered(few) == ordered(all_rows)
    assert shuffled_bytes(few) < 0.25 * shuffled_bytes(all_rows)


def test_few_copies_compare_rows_in_full(spark):
    nan = float("nan")
    data = [(1, "a", 0.0), (1, "a", -0.0), (None, "a", nan), (None, "a", nan), (1, None, None), (1, None, None), (None, None, None), (2, "1", 2.0), (1, "2", 2.0)]
    data += [(k, None, None) for k in range(9)] + [(None, str(k), None) for k in range(9)]
    df = spark.createDataFrame(data * 2, "a int, `b.c` string, d double").repartition(5)
    want = ordered(rows.drop_copies(df))
    whole = [F.hash("a"), F.lit(0)]
    for got in (rows.drop_copies(df, few=True), rows.drop_copies_by(df, [F.lit(1)]), rows.drop_copies_by(df, whole)):
        assert got.columns == df.columns and repr(ordered(got)) == repr(want)
    assert rows.drop_copies(df.limit(0), few=True).count() == 0
