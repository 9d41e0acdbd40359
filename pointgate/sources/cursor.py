"""Resuming a folder run after the last file done.

The cursor is the newest row of a small table; plain Structured Streaming sources keep theirs in the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pointgate.session import path_exists

IN_PROGRESS = "in_progress"
COMPLETED = "completed"
_SCHEMA = "version int, source string, status string, last_path string, cursor string, seq bigint"


class RunCompleted(RuntimeError):
    """The state says this run was finished; it is not started again."""


def load_state(spark: SparkSession, state_path: str) -> Row | None:
    """The newest state, null for a fresh start."""
    if not path_exists(spark, state_path):
        return None
    return spark.read.schema(_SCHEMA).json(state_path).orderBy(F.col("seq").desc_nulls_last()).first()


def load_cursor(spark: SparkSession, state_path: str) -> str | None:
    """The last file done, null for a fresh start.  A finished run may not be repeated."""
    row = load_state(spark, state_path)
    if row is None:
        return None
    if row.status == COMPLETED:
        raise RunCompleted(state_path)
    return row.last_path


def save_cursor(
    spark: SparkSession,
    state_path: str,
    last_path: str | None,
    status: str = IN_PROGRESS,
    cursor: str | None = None,
    source: str = "file",
) -> None:
    """Add a state.  Earlier ones stay, so a failure while writing leaves the one before in force."""
    before = load_state(spark, state_path)
    seq = 1 if before is None else (before.seq or 0) + 1
    row = spark.createDataFrame([(1, source, status, last_path, cursor, seq)], _SCHEMA)
    row.coalesce(1).write.mode("append").json(state_path)


def last_file(df: DataFrame) -> DataFrame:
    """One row with the greatest file path read."""
    return df.agg(F.max("file_path").alias("last_path"))
