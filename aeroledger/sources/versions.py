"""Atomic replacement of a table: versions in folders of their own, and a pointer that readers follow.

A job writes a new version next to the one that readers use. Only when all its
files are there is the pointer replaced, which is one small file and one rename.
A job that fails before leaves the old table as it is. The version before the
current one stays for readers that have already looked up its files; older ones
and those of failed jobs go when the next version is published.

A folder without a pointer is a plain parquet table. Files work through Hadoop's
file systems, so the folders may lie wherever Spark can write.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

# Spark's readers skip names that begin with an underscore.
POINTER = "_current"
VERSIONS = "_versions"


def _path(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def current_version(spark: SparkSession, table: str) -> str | None:
    """What the pointer says: the folder of the current version, relative to the table; None without a pointer."""
    fs, pointer = _path(spark, f"{table}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def files_of(spark: SparkSession, table: str) -> str:
    """The folder that holds the table's files."""
    version = current_version(spark, table)
    return table if version is None else f"{table}/{version}"


def new_version(table: str) -> str:
    """Folder for a new version, relative to the table; later ones sort behind earlier ones."""
    return f"{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, table: str, version: str) -> None:
    """Let readers see a version whose files are complete."""
    before = current_version(spark, table)
    point_to(spark, table, version)
    _clean(spark, table, {v.split("/")[1] for v in (before, version) if v})


def point_to(spark: SparkSession, table: str, target: str) -> None:
    """Replace the pointer of a table in one rename."""
    fs, pointer = _path(spark, f"{table}/{POINTER}")
    _, written = _path(spark, f"{table}/{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(written)
    try:
        stream.write(bytearray(target.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(written), fs.makeQualified(pointer), options)


def _clean(spark: SparkSession, table: str, keep: set[str]) -> None:
    """Remove versions older than those to keep, and what a plain table has left; a version that is still being written is newer."""
    fs, root = _path(spark, table)
    newest = max(keep)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            fs.delete(status.getPath(), True)
    for status in fs.listStatus(_path(spark, f"{table}/{VERSIONS}")[1]):
        name = status.getPath().getName()
        if name not in keep and name < newest:
            fs.delete(status.getPath(), True)
