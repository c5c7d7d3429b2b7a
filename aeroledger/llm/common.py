"""Helpers that the operators share: byte-balanced Arrow batches and durable intermediate results."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices whose `column` (text or binary) holds about `max_bytes`; a longer single value stays whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        slot = (np.cumsum(sizes) - sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(slot)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; set below the warehouse only where the session has none.

    A folder that is set here is the session's own and goes when its JVM ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
        path = spark._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return context.getCheckpointDir()


def durable(frame: DataFrame) -> DataFrame:
    """Compute once and keep in the shared checkpoint folder: later steps start there, whichever executor is lost."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)
