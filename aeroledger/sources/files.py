"""CSV scans, parquet tables and raw -> bronze ingestion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aeroledger.functions.fixed_values import RAW_FILES, RAW_SCHEMAS, TABLE_FOLDERS
from aeroledger.sources import versions

# About 1 GB for the widest table, so that no file of a hot month grows without bound.
MAX_RECORDS_PER_FILE = 10_000_000


def table_path(base: str, name: str) -> str:
    """Folder of a table below its layer's folder."""
    return f"{base}/{TABLE_FOLDERS.get(name, name)}"


def read_raw_csv(
    spark: SparkSession, path: str, schema: str | StructType | None = None, mode: str = "FAILFAST", bad_line: str | None = None
) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file once more to infer it.

    With a schema, its columns are found by their names in the header, in any
    order; other columns are left out and an absent one is an error. All files of
    a folder have to agree on the header. A cell that does not fit its type stops
    the scan, so no value turns into NULL unnoticed; ``mode="PERMISSIVE"`` reads
    such cells as NULL and ``mode="DROPMALFORMED"`` leaves their rows out. With
    ``bad_line`` the scan goes on, and a column of that name has the text of each
    line with such a cell, or with another number of cells than the header; else NULL.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    struct = _struct(schema)
    header = reader.csv(path).columns
    absent = [n for n in struct.names if n not in header]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}; its header has {', '.join(header)}")
    typed = StructType([struct[n] if n in struct.names else StructField(n, StringType()) for n in header])
    names = struct.names
    if bad_line is not None:
        typed, names, mode = typed.add(bad_line, StringType()), [*names, bad_line], "PERMISSIVE"
        # all columns are parsed, so that lines with too few or too many cells show as well
        reader = reader.option("columnNameOfCorruptRecord", bad_line).option("columnPruning", False)
    reader = reader.schema(typed).option("enforceSchema", False).option("mode", mode)
    return reader.csv(path).select(*[f"`{n}`" for n in names])


def malformed_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Column line: the lines of a CSV that have a cell which does not fit its type."""
    by_name = {f.name: f for f in _struct(schema)}
    header = spark.read.option("header", True).csv(path).columns
    typed = StructType([by_name.get(n, StructField(n, StringType())) for n in header]).add("_malformed", StringType())
    lines = spark.read.text(path)
    parsed = F.from_csv("value", typed.toDDL(), {"columnNameOfCorruptRecord": "_malformed"})
    bad = lines.select(F.col("value").alias("line"), parsed["_malformed"].alias("malformed")).where("malformed IS NOT NULL")
    return bad.select("line").where(F.col("line") != lines.first()[0])


def _struct(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True) -> None:
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        # Replace the whole table whatever the session's overwrite mode is.
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    writer.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a plain parquet folder. A job that fails leaves no table; :func:`replace_table` leaves the old one.

    A partitioned table is rebalanced on its partition columns first: a month
    that holds much of the data is split over many tasks, and a small one makes
    one file instead of one per task.
    """
    _write(df, path, partition_by)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
    """Replace a parquet table at once: readers see the old one until all files of the new one are written.

    The files are laid out as by :func:`write_table`, in a version of their own
    (see :mod:`aeroledger.sources.versions`). ``df`` may read the table it replaces.
    ``rebalance=False`` is for rows that already lie together by their partition
    columns; it saves a shuffle of the table.
    """
    version = versions.new_version(path)
    _write(df, f"{path}/{version}", partition_by, rebalance)
    versions.publish(df.sparkSession, path, version)


def read_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet table, plain or in versions. With a schema the columns come in its order and types,

    where a plain read puts partition columns last and guesses their types.
    """
    folder = versions.files_of(spark, path)
    if schema is None:
        return spark.read.parquet(folder)
    struct = _struct(schema)
    return spark.read.schema(struct).parquet(folder).select(*struct.names)


def ingest(spark: SparkSession, name: str, raw: str, bronze: str, mode: str = "FAILFAST") -> None:
    """Copy one raw CSV data set to its bronze parquet table; ``mode`` as in :func:`read_raw_csv`."""
    source = read_raw_csv(spark, f"{raw}/{RAW_FILES[name]}", RAW_SCHEMAS[name], mode)
    replace_table(source, table_path(bronze, name))


@dataclass(frozen=True)
class Ingested:
    """Lines of an ingestion, without headers; ``lines = loaded + rejected``."""

    lines: int
    loaded: int
    rejected: int


BAD_LINE = "malformed_line"


def ingest_with_quarantine(spark: SparkSession, name: str, raw: str, bronze: str) -> Ingested:
    """Copy one raw CSV data set, and keep the lines aside that do not fit its types or its number of columns.

    One scan and one job write both parts and count them. They are published
    together: the bronze table shows the good rows, :func:`rejected_lines` the
    text of the others.
    """
    path, counts = table_path(bronze, name), Observation()
    source = read_raw_csv(spark, f"{raw}/{RAW_FILES[name]}", RAW_SCHEMAS[name], bad_line=BAD_LINE)
    rejected = F.col(BAD_LINE).isNotNull()
    counted = source.observe(counts, F.count("*").alias("lines"), F.count_if(rejected).alias("rejected"))
    version = versions.new_version(path)
    # no rebalancing: it would shuffle the table for the sake of a few bad lines
    writer = counted.withColumn("rejected", rejected).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    writer.partitionBy("rejected").parquet(f"{path}/{version}")
    if counts.get["lines"] == counts.get["rejected"]:  # a folder without any good row is not written
        empty = spark.createDataFrame([], _struct(RAW_SCHEMAS[name]))
        empty.write.parquet(f"{path}/{version}/rejected=false")
    versions.publish(spark, path, f"{version}/rejected=false")
    return Ingested(counts.get["lines"], counts.get["lines"] - counts.get["rejected"], counts.get["rejected"])


def read_bronze(spark: SparkSession, name: str, bronze: str) -> DataFrame:
    """A bronze table in the column order of its raw data set."""
    return read_table(spark, table_path(bronze, name), RAW_SCHEMAS[name])


def rejected_lines(spark: SparkSession, name: str, bronze: str) -> DataFrame:
    """Column line: the lines that the last ingestion with quarantine kept aside."""
    path = table_path(bronze, name)
    version = versions.current_version(spark, path) or ""
    whole = f"{path}/{version.removesuffix('/rejected=false')}"
    if not version.endswith("/rejected=false") or not versions.exists(spark, f"{whole}/rejected=true"):
        return spark.createDataFrame([], "line string")
    return spark.read.schema(f"{BAD_LINE} string").parquet(f"{whole}/rejected=true").select(F.col(BAD_LINE).alias("line"))
