"""Files written and read back, and the JDBC writer's settings."""

import glob
import json
import os
import sys
import uuid
from datetime import date

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from aeroledger.functions import fixed_values as fixed
from aeroledger.plans import medallion, silver
from aeroledger.sources import files, jdbc
from conftest import ordered
from harness import fixtures


def test_csv_with_schema_keeps_blanks_and_nulls(spark, tmp_path):
    (tmp_path / "a.csv").write_text('IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n n1 ,"X, Y",C,,USA,1.5,-2\n')
    df = files.read_raw_csv(spark, str(tmp_path / "a.csv"), fixed.RAW_SCHEMAS["airports"])
    assert tuple(df.first()) == (" n1 ", "X, Y", "C", None, "USA", 1.5, -2.0)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("AIRPORT,LATITUDE,IATA_CODE,more,CITY,STATE,COUNTRY,LONGITUDE\nX,1,n1,z,C,NY,USA,2\n")
    (tmp_path / "b.csv").write_text("AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\nX,C,NY,USA,1,2\n")
    df = files.read_raw_csv(spark, str(tmp_path / "a.csv"), fixed.RAW_SCHEMAS["airports"])
    assert [tuple(r) for r in df.collect()] == [("n1", "X", "C", "NY", "USA", 1.0, 2.0)] and df.count() == 1
    with pytest.raises(ValueError, match="lacks the columns IATA_CODE"):
        files.read_raw_csv(spark, str(tmp_path / "b.csv"), fixed.RAW_SCHEMAS["airports"])


@pytest.mark.parametrize("name", list(fixed.RAW_FILES))
def test_ingest_in_another_column_order(spark, sf_dir, tmp_path, name):
    raw = fixtures.raw(spark, sf_dir, name)
    moved = raw.select(F.lit("z").alias("more"), *reversed(raw.columns))
    fixtures.write_raw_csv(moved, f"{tmp_path}/raw/{fixed.RAW_FILES[name]}")
    files.ingest(spark, name, f"{tmp_path}/raw", f"{tmp_path}/bronze")
    bronze = files.read_table(spark, files.table_path(f"{tmp_path}/bronze", name))
    assert bronze.dtypes == raw.dtypes
    assert ordered(bronze) == ordered(raw)


def test_bad_cells_can_be_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pres,time,airport_id,tavg,tmin,tmax,prcp,snow,wdir,wspd\n1,2023-01-01,n1,x,2,3,,,,4\n1,2023-01-01,n1,1,2,3,,,,4\n")
    path, schema = str(tmp_path / "a.csv"), fixed.RAW_SCHEMAS["weather"]
    assert [r.line for r in files.malformed_lines(spark, path, schema).collect()] == ["1,2023-01-01,n1,x,2,3,,,,4"]
    assert files.read_raw_csv(spark, path, schema, mode="DROPMALFORMED").select("tavg").collect() == [(1.0,)]


def test_csv_scan_of_some_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,airport_id,tavg,tmin,tmax,prcp,snow,wdir,wspd,pres\n2023-01-01,n1,1,2,3,,,,4,5\n")
    df = files.read_raw_csv(spark, str(tmp_path / "a.csv"), fixed.RAW_SCHEMAS["weather"])
    assert df.count() == 1
    assert tuple(df.select("wspd", "airport_id").first()) == (4.0, "n1")


def test_csv_cell_of_another_type_stops_the_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,airport_id,tavg,tmin,tmax,prcp,snow,wdir,wspd,pres\n2023-01-01,n1,x,2,3,,,,4,5\n")
    path, schema = str(tmp_path / "a.csv"), fixed.RAW_SCHEMAS["weather"]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_raw_csv(spark, path, schema).collect()
    assert files.read_raw_csv(spark, path, schema, mode="PERMISSIVE").first().tavg is None


def test_csv_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2023-01-05,05-01-2023\n2,2023-01-06,06-01-2023\n")
    assert files.read_raw_csv(spark, str(tmp_path / "a.csv")).dtypes == [("a", "int"), ("b", "date"), ("c", "string")]


def test_partitioned_table_restores_order_and_null_partition(spark, tmp_path):
    data = [(2023, None, "a"), (2023, 1, "b"), (None, None, "c")]
    df = spark.createDataFrame(data, "y int, m int, v string")
    path = str(tmp_path / "t")
    files.write_table(df, path, ["y", "m"])
    assert spark.read.parquet(path).columns == ["v", "y", "m"]
    back = files.read_table(spark, path, "y int, m int, v string")
    assert back.dtypes == df.dtypes
    assert ordered(back) == ordered(df)


def test_overwrite_replaces_all_partitions_in_any_mode(spark, conf, tmp_path):
    conf({"spark.sql.sources.partitionOverwriteMode": "dynamic"})
    path = str(tmp_path / "t")
    files.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string"), path, ["m"])
    files.write_table(spark.createDataFrame([(3, "c")], "m int, v string"), path, ["m"])
    assert ordered(files.read_table(spark, path, "m int, v string")) == [(3, "c")]


def test_partition_files_do_not_grow_with_tasks(spark, tmp_path):
    df = spark.range(0, 4000, numPartitions=40).withColumn("m", F.col("id") % 3)
    path = str(tmp_path / "t")
    files.write_table(df, path, ["m"])
    assert len(glob.glob(f"{path}/m=*/*.parquet")) == 3


def test_hot_partition_is_split_over_tasks(spark, conf, tmp_path):
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"})
    hot = F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 3).cast("int")
    df = spark.range(0, 400000, numPartitions=16).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), hot.alias("m"))
    path = str(tmp_path / "t")
    files.write_table(df, path, ["m"])
    assert len(glob.glob(f"{path}/m=1/*.parquet")) > 4
    assert spark.read.parquet(path).count() == 400000


def test_ingest_each_dataset(spark, sf_dir, tmp_path):
    for name, file in fixed.RAW_FILES.items():
        raw = fixtures.raw(spark, sf_dir, name)
        fixtures.write_raw_csv(raw, f"{tmp_path}/raw/{file}")
        files.ingest(spark, name, f"{tmp_path}/raw", f"{tmp_path}/bronze")
        bronze = files.read_table(spark, files.table_path(f"{tmp_path}/bronze", name))
        assert bronze.dtypes == raw.dtypes
        assert ordered(bronze) == ordered(raw)


def test_raw_csv_is_compressed_in_files_for_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "RAW_RECORDS_PER_FILE", 1000)
    path = f"{tmp_path}/raw/{fixed.RAW_FILES['airports']}"
    df = spark.range(4500, numPartitions=1).selectExpr(
        "concat(' n', id, ' ') AS IATA_CODE", "'X, Y' AS AIRPORT", "'C' AS CITY", "string(NULL) AS STATE", "'USA' AS COUNTRY", "id / 3 AS LATITUDE", "double(-id) AS LONGITUDE"
    )
    fixtures.write_raw_csv(df, path)
    found = glob.glob(f"{path}/*.csv*")
    assert len(found) == 5 and all(open(f, "rb").read(2) == b"\x1f\x8b" for f in found)
    files.ingest(spark, "airports", f"{tmp_path}/raw", f"{tmp_path}/bronze")
    bronze = files.read_bronze(spark, "airports", f"{tmp_path}/bronze")
    assert ordered(bronze) == ordered(df)


def test_one_job_at_a_time(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    for name in ("flights", "airports"):
        fixtures.raw(spark, sf_dir, name).write.parquet(f"{base}/bronze/{name}")
        medallion.build_silver(spark, name, base)
        stored = medallion.read_silver(spark, base, name).drop("silver_load_timestamp")
        direct = silver.SILVER[name](fixtures.raw(spark, sf_dir, name)).drop("silver_load_timestamp")
        assert stored.columns == direct.columns
        assert ordered(stored) == ordered(direct)
    medallion.build_gold(spark, "flight_performance", base)
    table = files.read_table(spark, f"{base}/gold/flight_performance")
    assert table.agg(F.sum("total_flights")).first()[0] == medallion.read_silver(spark, base, "flights").count()


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(10).withColumn("m", F.col("id") % 2), path, ["m"])
    bad = spark.range(100_000, numPartitions=8).withColumn("m", F.when(F.col("id") == 99_999, F.raise_error(F.lit("late"))).otherwise(F.col("id") % 2))
    with pytest.raises(Exception, match="late"):
        files.replace_table(bad, path, ["m"])
    assert files.read_table(spark, path).count() == 10
    reader = files.read_table(spark, path)
    files.replace_table(files.read_table(spark, path).filter("id < 3"), path)  # from the table itself
    assert ordered(files.read_table(spark, path).select("id")) == [(0,), (1,), (2,)]
    assert reader.count() == 10  # found its files before
    files.replace_table(spark.range(1), path)
    assert len(glob.glob(f"{path}/_versions/*")) == 2 and files.read_table(spark, path).count() == 1


def test_plain_table_becomes_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(5), path)
    assert files.read_table(spark, path).count() == 5
    files.replace_table(spark.range(7), path)
    assert files.read_table(spark, path).count() == 7 and not glob.glob(f"{path}/*.parquet")


def test_quarantine_keeps_every_line(spark, tmp_path):
    head = "pres,time,airport_id,tavg,tmin,tmax,prcp,snow,wdir,wspd,more\n"
    good, bad = "1,2023-01-01,n1,1,2,3,,,,4,z\n", ["1,2023-01-01,n1,x,2,3,,,,4,z", "1,soon,n1,1,2,3,,,,4,z", "1,2023-01-01"]
    raw, bronze = tmp_path / "raw" / fixed.RAW_FILES["weather"], str(tmp_path / "bronze")
    raw.mkdir(parents=True)
    for k in range(3):
        (raw / f"{k}.csv").write_text(head + good * 4 + bad[k] + "\n")
    counted = files.ingest_with_quarantine(spark, "weather", str(tmp_path / "raw"), bronze)
    assert (counted.lines, counted.loaded, counted.rejected) == (15, 12, 3)
    table = files.read_bronze(spark, "weather", bronze)
    assert table.count() == 12 and table.dtypes == spark.createDataFrame([], fixed.RAW_SCHEMAS["weather"]).dtypes
    assert files.read_table(spark, files.table_path(bronze, "weather")).count() == 12
    assert sorted(r.line for r in files.rejected_lines(spark, "weather", bronze).collect()) == sorted(bad)
    for text, want in ((head + good, (1, 1, 0)), (head + bad[0] + "\n", (1, 0, 1)), (head, (0, 0, 0))):
        for k in range(3):
            (raw / f"{k}.csv").write_text(text if k == 0 else head)
        counted = files.ingest_with_quarantine(spark, "weather", str(tmp_path / "raw"), bronze)
        assert (counted.lines, counted.loaded, counted.rejected) == want
        assert files.read_bronze(spark, "weather", bronze).count() == want[1]
        assert files.rejected_lines(spark, "weather", bronze).count() == want[2]


@pytest.mark.parametrize("name", list(fixed.RAW_FILES))
def test_silver_build_counts_its_rows(spark, sf_dir, tmp_path, name):
    from harness.queries import QUERIES

    fixtures.raw(spark, sf_dir, name).write.parquet(files.table_path(f"{tmp_path}/bronze", name))
    counted = medallion.build_silver(spark, name, str(tmp_path))
    assert vars(counted) == QUERIES[f"q7_audit_{name}"](spark, sf_dir).first().asDict()
    assert counted.silver_rows == medallion.read_silver(spark, str(tmp_path), name).count()


class RecordingWriter:
    def __init__(self):
        self.options, self.call = {}, None

    def mode(self, mode):
        self.options["mode"] = mode
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def jdbc(self, **call):
        self.call = call


def test_jdbc_settings():
    class Frame:
        write = RecordingWriter()

    login = {"user": "u", "password": "p", "driver": "d"}
    jdbc.write_jdbc(Frame, "jdbc:x", "silver_flights", login, connections=4, batch_size=5)
    assert Frame.write.options == {"mode": "overwrite", "numPartitions": 4, "batchsize": 5, "truncate": True}
    assert Frame.write.call == {"url": "jdbc:x", "table": "silver_flights", "properties": login}


class Recorded:
    """Stands in for a database: statements go to a file, and the parts noted as done are a set of file names."""

    def __init__(self, folder, fail_at=None):
        self.folder, self.fail_at, self.pending = folder, fail_at, []

    def cursor(self):
        return self

    def execute(self, sql, values=()):
        if self.fail_at is not None and sql.startswith("INSERT INTO t_parts") and values[0] == self.fail_at:
            raise ConnectionError("lost")
        self.pending.append((sql, values))
        self.last = values

    def executemany(self, sql, rows):
        self.pending.append((sql, list(rows)))

    def fetchone(self):
        return (int(os.path.exists(f"{self.folder}/done-{self.last[0]}")),)

    def commit(self):
        for sql, values in self.pending:
            if sql.startswith("INSERT INTO t_parts"):
                open(f"{self.folder}/done-{values[0]}", "w").close()
        with open(f"{self.folder}/log-{os.getpid()}-{uuid.uuid4().hex}", "w") as log:
            json.dump(self.pending, log)
        self.pending = []

    def close(self):
        pass


def test_export_writes_each_part_in_a_transaction(tmp_path):
    rows = pa.RecordBatch.from_pylist([{"a": 1, "export_part": 0}, {"a": 2, "export_part": 0}, {"a": 3, "export_part": 0}, {"a": 4, "export_part": 2}])
    connection = Recorded(str(tmp_path))
    transactions = []
    commit = connection.commit
    connection.commit = lambda: (transactions.append([s.split(" WHERE")[0].split(" (")[0] for s, _ in connection.pending]), commit())
    target = jdbc.Target(lambda: connection, "t")
    assert list(jdbc.write_parts(iter([rows[:1], rows[1:]]), target, 2)) == [0, 2]
    one = ["SELECT count", "DELETE FROM t_staging", "INSERT INTO t_staging", "INSERT INTO t_parts"]
    assert [[s.split("(")[0] for s in t] for t in transactions] == [[*one[:3], *one[2:]], one]
    assert list(jdbc.write_parts(iter([rows]), target, 2)) == []  # noted as done
    transactions.clear()
    connection.pending = []
    jdbc.publish(target, ["a"])
    assert transactions == [["DELETE FROM t", "INSERT INTO t", "DELETE FROM t_staging", "DELETE FROM t_parts"]]


def test_export_goes_on_after_a_failure(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not find test modules
    folder = str(tmp_path)
    df = spark.range(500).select("id", F.col("id").cast("string").alias("text"))
    with pytest.raises(Exception, match="lost"):
        jdbc.export(df, jdbc.Target(lambda: Recorded(folder, fail_at=3), "t"), parts=8, connections=1)
    before = len(glob.glob(f"{folder}/done-*"))
    assert before == 3
    assert not [x for log in glob.glob(f"{folder}/log-*") for x in json.load(open(log)) if x[0] == "DELETE FROM t"]
    assert jdbc.export(df, jdbc.Target(lambda: Recorded(folder), "t"), parts=8, connections=2) == 8 - before
    said = [x for log in glob.glob(f"{folder}/log-*") for x in json.load(open(log))]
    staged = [tuple(r[:2]) for sql, rows in said if sql.startswith("INSERT INTO t_staging (") for r in rows]
    assert sorted(staged) == sorted((i, str(i)) for i in range(500))
    assert sum(sql == "DELETE FROM t" for sql, _ in said) == 1


def test_export_copies_the_silver_flights(spark, sf_dir, tmp_path, monkeypatch):
    base, calls = str(tmp_path), []
    fixtures.raw(spark, sf_dir, "flights").write.parquet(f"{base}/bronze/flights")
    medallion.build_silver(spark, "flights", base)
    monkeypatch.setattr(medallion, "write_jdbc", lambda *args: calls.append(args))
    medallion.export_flights(spark, base, "jdbc:x", {"driver": "d"})
    (df, url, table, properties), = calls
    assert (url, table, properties) == ("jdbc:x", "silver_flights", {"driver": "d"})
    assert df.columns[:4] == ["flightdate", "flight_year", "flight_month", "flight_day"]
    assert df.count() == medallion.read_silver(spark, base, "flights").count()


def test_scratch_is_new_and_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = fixtures.scratch_dir(spark), fixtures.scratch_dir(spark)
    assert first != second
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    assert first.startswith(f"{shared.rstrip('/')}/aeroledger-")


def test_queries_leave_the_session_alone(spark, sf_dir):
    from harness.queries import QUERIES

    before = {r.key: r.value for r in spark.sql("SET").collect()}
    QUERIES["silver_airports"](spark, sf_dir).count()
    QUERIES["s2_parquet_roundtrip"](spark, sf_dir).count()
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before


def test_null_dates_survive_the_flight_partitions(spark, tmp_path):
    schema = fixed.RAW_SCHEMAS["weather"]
    df = spark.createDataFrame([(date(2023, 1, 1), "a", *[1.0] * 8), (None, "b", *[None] * 8)], schema)
    path = str(tmp_path / "weather")
    files.write_table(silver.silver_weather(df), path, fixed.SILVER_PARTITIONS["weather"])
    back = files.read_table(spark, path, fixed.SILVER_SCHEMAS["weather"])
    assert ordered(back.select("iata_code", "weather_year", "weather_month")) == [("A", 2023, 1), ("B", None, None)]
