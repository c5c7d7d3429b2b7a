"""Database sinks: Spark's JDBC writer, and an export that can be run again after a failure."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from itertools import groupby
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:  # only the export needs the library
    import pyarrow as pa


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Replace a database table.

    ``properties`` carries the driver class and the caller's credentials. At
    most ``connections`` tasks write at once, so a large cluster does not flood
    the database, and an existing table is emptied rather than dropped, which
    keeps its indexes and grants.
    """
    (
        df.write.mode("overwrite")
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", True)
        .jdbc(url=url, table=table, properties=dict(properties))
    )


PART = "export_part"


@dataclass(frozen=True)
class Target:
    """A database table and how to reach it.

    ``connect`` opens a DB-API connection and is called in the driver and in the
    tasks. Beside ``table`` there are two more, which the database's owner has
    created: ``table_staging`` with the same columns and ``export_part``, and
    ``table_parts`` with ``export_part``. ``mark`` stands for a value in a statement.
    """

    connect: Callable[[], Any]
    table: str
    mark: str = "?"

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    @property
    def parts(self) -> str:
        return f"{self.table}_parts"


def export(df: DataFrame, target: Target, parts: int = 64, connections: int = 16, batch_size: int = 10_000) -> int:
    """Replace a database table in one transaction at the end; returns the number of parts written by this run.

    Rows are dealt to ``parts`` by a hash of their values, so each run makes the
    same parts. A task writes a part to the staging table in a transaction of its
    own, after it has deleted what a failed attempt may have left, and notes the
    part as done; parts that are noted are skipped. The target changes only when
    all parts are there. ``parts`` bounds a transaction, ``connections`` the
    tasks that write at once.
    """
    values = [F.col(f"`{c}`") for c in df.columns]
    dealt = df.withColumn(PART, F.pmod(F.xxhash64(*values), F.lit(parts)).cast("int"))
    sorted_parts = dealt.repartition(min(connections, parts), PART).sortWithinPartitions(PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        done = list(write_parts(batches, target, batch_size))
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int32())], [PART])

    written = sorted_parts.mapInArrow(run, f"{PART} int").count()
    publish(target, df.columns)
    return written


def write_parts(batches: Iterator[pa.RecordBatch], target: Target, batch_size: int) -> Iterator[int]:
    """Write the parts of one task, whose rows are sorted by part; yields the parts that were not there yet."""
    rows = (row for batch in batches for row in batch.to_pylist())
    connection = target.connect()
    try:
        cursor = connection.cursor()
        for part, own in groupby(rows, key=lambda row: row[PART]):
            cursor.execute(f"SELECT count(*) FROM {target.parts} WHERE {PART} = {target.mark}", (part,))
            if cursor.fetchone()[0]:
                continue
            cursor.execute(f"DELETE FROM {target.staging} WHERE {PART} = {target.mark}", (part,))
            held: list[tuple] = []
            for row in own:
                held.append(tuple(row.values()))
                if len(held) == batch_size:
                    _insert(cursor, target, list(row), held)
            if held:
                _insert(cursor, target, list(row), held)
            cursor.execute(f"INSERT INTO {target.parts} ({PART}) VALUES ({target.mark})", (part,))
            connection.commit()
            yield part
    finally:
        connection.close()  # what is not committed is lost, as it should be


def _insert(cursor: Any, target: Target, columns: list[str], rows: list[tuple]) -> None:
    marks = ", ".join([target.mark] * len(columns))
    cursor.executemany(f"INSERT INTO {target.staging} ({', '.join(columns)}) VALUES ({marks})", rows)
    rows.clear()


def publish(target: Target, columns: list[str]) -> None:
    """Put the staged rows in place of the target's and forget the staging, in one transaction."""
    names = ", ".join(columns)
    connection = target.connect()
    try:
        cursor = connection.cursor()
        cursor.execute(f"DELETE FROM {target.table}")
        cursor.execute(f"INSERT INTO {target.table} ({names}) SELECT {names} FROM {target.staging}")
        cursor.execute(f"DELETE FROM {target.staging}")
        cursor.execute(f"DELETE FROM {target.parts}")
        connection.commit()
    finally:
        connection.close()
