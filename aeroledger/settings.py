"""Session settings that follow the size of the input."""

from __future__ import annotations

MB = 1024 * 1024
TASK_BYTES = 128 * MB
# The driver tracks every map task and every shuffle holds tasks x partitions
# blocks, so very large inputs get larger tasks: from FEW_TASKS on they grow with
# the input, but never beyond what a task can hold.
FEW_TASKS = 30_000
MAX_TASK_BYTES = 1024 * MB
# Rows in a shuffle, against their compressed parquet size.
SHUFFLE_GROWTH = 3


def task_bytes(total_bytes: int) -> int:
    """Bytes for one task of a stage that reads or shuffles so many."""
    return min(max(TASK_BYTES, -(-total_bytes // FEW_TASKS)), MAX_TASK_BYTES)


def shuffle_partitions(input_bytes: int, least: int = 1) -> int:
    """Shuffle partitions for an input of so many compressed bytes.

    Exact-copy removal shuffles whole rows, and the partitions of an
    aggregation cannot be split at run time, so there have to be enough of them
    beforehand. Adaptive execution joins those that turn out small.
    """
    shuffled = SHUFFLE_GROWTH * input_bytes
    return max(least, -(-shuffled // task_bytes(shuffled)))


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark options to build a session with."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes(SHUFFLE_GROWTH * input_bytes)),
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores)),
        "spark.sql.files.maxPartitionBytes": str(task_bytes(input_bytes)),
        "spark.sql.session.timeZone": "UTC",
    }
