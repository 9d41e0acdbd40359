"""Counters of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pointgate.operators import points as P


def _outcomes():
    return [
        F.count_if(F.col("status") == P.ACCEPTED).alias("accepted"),
        F.count_if(F.col("status") == P.REJECTED).alias("dropped"),
    ]


def outcome_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accepted and dropped records (per ``by``)."""
    return df.groupBy(*by).agg(*_outcomes())


def observe_outcomes(df: DataFrame, observation: Observation | str) -> DataFrame:
    """Collect the same counters while the frame is written, without another pass."""
    return df.observe(observation, *_outcomes())


def counts_per_file(df: DataFrame, path: str = "file_path") -> DataFrame:
    return outcome_counts(df, [path])
