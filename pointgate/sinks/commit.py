"""Two outputs that become visible together.

A run writes its accepted records and its dead letter below ``run=<id>`` folders of its own, with overwrite, and then
one row to the manifest.  Readers take only runs that have their row: a run that failed in between is invisible, and
repeating it under its id doubles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.operators.counts import outcome_counts
from pointgate.options import GateOptions, OutputOptions
from pointgate.session import path_exists, scratch, staged
from pointgate.sinks.write import quarantine_unwritable, write_accepted, write_dead_letter

MANIFEST = "run_id string, accepted bigint, dropped bigint, as_of_ms bigint"


@dataclass(frozen=True)
class Outputs:
    """Where the runs of one job lie: ``accepted``, ``dead`` and ``manifest`` below one folder."""

    root: str

    @property
    def accepted(self) -> str:
        return f"{self.root}/accepted"

    @property
    def dead(self) -> str:
        return f"{self.root}/dead"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"


def commit_run(
    df: DataFrame,
    outputs: Outputs,
    run_id: str,
    field_count: int,
    opts: OutputOptions,
    gate: GateOptions | None = None,
    as_of_ms: int | None = None,
    dead_letter_text: bool = True,
) -> dict[str, int]:
    """Write a gated frame as one run and commit it; returns the counters of what was written.

    The frame is evaluated once: it is staged in the shared folder, and counts and outputs come from that copy.
    """
    if not run_id or "/" in run_id or "=" in run_id:
        raise ValueError(f"not a run id: {run_id!r}")
    spark = df.sparkSession
    with scratch(spark):
        judged = staged(quarantine_unwritable(df, opts, field_count), "judged")
        counters = outcome_counts(judged).first().asDict()
        write_accepted(judged, f"{outputs.accepted}/run={run_id}", field_count, opts, as_of_ms, mode="overwrite")
        write_dead_letter(
            judged, f"{outputs.dead}/run={run_id}", opts, gate, as_of_ms, dead_letter_text, mode="overwrite"
        )
    row = [(run_id, counters["accepted"], counters["dropped"], as_of_ms)]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{outputs.manifest}/run={run_id}")
    return counters


def committed_runs(spark: SparkSession, outputs: Outputs) -> DataFrame:
    """The manifest: one row per committed run."""
    if not path_exists(spark, outputs.manifest):
        return spark.createDataFrame([], MANIFEST)
    # a run that failed while it wrote its row left a folder without a file
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(outputs.manifest)


def _read(spark: SparkSession, outputs: Outputs, base: str, opts: OutputOptions, text: bool) -> DataFrame | None:
    runs = [row["run_id"] for row in committed_runs(spark, outputs).select("run_id").orderBy("run_id").collect()]
    paths = [f"{base}/run={run}" for run in runs if path_exists(spark, f"{base}/run={run}")]
    if not paths:
        return None
    reader = spark.read.option("basePath", base).option("header", True)
    if text:
        return reader.text(paths)
    return reader.csv(paths) if opts.format == "csv" else reader.parquet(*paths)


def read_accepted(spark: SparkSession, outputs: Outputs, opts: OutputOptions) -> DataFrame | None:
    """Accepted records of the committed runs with their ``run``; None before the first commit."""
    found = _read(spark, outputs, outputs.accepted, opts, opts.format in ("jsonl", "canonical_jsonl"))
    return None if found is None else found.withColumn("run", F.col("run").cast("string"))


def read_dead_letter(
    spark: SparkSession, outputs: Outputs, opts: OutputOptions, as_text: bool = True
) -> DataFrame | None:
    """Dead letters of the committed runs with their ``run``; None before the first commit."""
    found = _read(spark, outputs, outputs.dead, OutputOptions(), as_text)
    return None if found is None else found.withColumn("run", F.col("run").cast("string"))
