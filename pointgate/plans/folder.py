"""A run over a folder of files that survives bad files and goes on where the last one ended."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.operators.counts import counts_per_file
from pointgate.operators.gate import apply_checks
from pointgate.operators.points import FILE_READ_ERROR
from pointgate.options import GateOptions, OutputOptions, PointMapping
from pointgate.plans.run import gate_points, run_clock
from pointgate.session import scratch, staged
from pointgate.sinks.write import quarantine_unwritable, write_accepted, write_dead_letter
from pointgate.sources import cursor as states
from pointgate.sources.files import FILE_ORDER, catalogue, directory_points, list_files, unreadable_files
from pointgate.sources.probe import probe

FORMATS = ("csv", "tsv", "json", "jsonl", "parquet")


def run_folder(
    spark: SparkSession,
    root: str,
    mapping: PointMapping,
    gate: GateOptions,
    output: OutputOptions,
    out: str,
    state: str,
    formats: Sequence[str] = FORMATS,
    as_of_ms: int | None = None,
    complete: bool = True,
    dead_letter_text: bool = True,
    **spike_options,
) -> dict[str, int]:
    """Gate the files after the saved cursor; write ``accepted``, ``dead`` and ``files`` below ``out``.

    The folder is listed once: exactly those files are read, and the last of them becomes the cursor.  A file of any
    format that cannot be read, or not to its end, gives one dead letter with its path and counts as failed; what was
    read of it is kept, and the other files go on.  Each run writes folders ``run=<number>`` of its own with
    overwrite, and the cursor is saved last: a run that failed in between is repeated without doubling records.
    ``complete`` marks the state as finished; a finished run raises ``RunCompleted``.  Returns the counters:
    accepted, dropped, files, failed.  ``files`` has one row per file.
    """
    as_of_ms = run_clock(as_of_ms)
    cursor = states.load_cursor(spark, state)
    before = states.load_state(spark, state)
    number = 1 if before is None else (before.seq or 0) + 1
    status = states.COMPLETED if complete else states.IN_PROGRESS
    files = [(path, kind) for path, kind in list_files(spark, root, cursor) if kind in formats]
    if not files:
        states.save_cursor(spark, state, cursor, status)
        return {"accepted": 0, "dropped": 0, "files": 0, "failed": 0}
    with scratch(spark):
        counters, last = _gated_folder(
            spark, root, mapping, gate, output, out, number, files, formats, as_of_ms, dead_letter_text, spike_options
        )
    states.save_cursor(spark, state, last, status)
    return counters


def _gated_folder(
    spark, root, mapping, gate, output, out, number, files, formats, as_of_ms, dead_letter_text, spike_options
) -> tuple[dict[str, int], str]:
    width = mapping.field_count
    found = catalogue(spark, files)
    points = directory_points(spark, root, mapping, formats, None, as_of_ms, found=found, lenient=True)
    gated = gate_points(points, gate, "file_path", FILE_ORDER, as_of_ms, width, **spike_options)
    # Decoded and judged once; all outputs and counts come from this copy.
    judged = staged(quarantine_unwritable(gated, output, width), "folder-run")
    # Files that failed the probe are among the staged points.  Parquet files cut short are found by their count of
    # rows; files without any row may have gone away since, which a second look tells.
    report = staged(_report(spark, found, judged), "folder-report")
    silent = [(r.file_path, r.format) for r in report.filter("accepted + dropped = 0 and not failed").collect()]
    gone = {r.path: r.error for r in probe(spark, silent, {}).filter("error is not null").collect()} if silent else {}
    if gone:
        report = staged(_report(spark, found, judged, list(gone)), "folder-report")
    reasons = {r.file_path: (r.format, "fewer rows than its footer promises") for r in report.filter("lost").collect()}
    reasons |= {path: (reasons[path][0], error) for path, error in gone.items()}
    if reasons:
        lost = apply_checks(unreadable_files(spark, [(p, *why) for p, why in reasons.items()]), gate, as_of_ms, width)
        judged = judged.unionByName(lost, allowMissingColumns=True)
    write_accepted(judged, f"{out}/accepted/run={number}", width, output, as_of_ms, mode="overwrite")
    write_dead_letter(judged, f"{out}/dead/run={number}", output, gate, as_of_ms, dead_letter_text, "overwrite")
    report.drop("lost").write.mode("overwrite").parquet(f"{out}/files/run={number}")
    counters = report.agg(
        F.sum("accepted").alias("accepted"),
        F.sum("dropped").alias("dropped"),
        F.count("*").alias("files"),
        F.count_if("failed").alias("failed"),
    ).first()
    return counters.asDict(), files[-1][0]


def _report(spark: SparkSession, found, judged: DataFrame, gone: Sequence[str] = ()) -> DataFrame:
    """Per file: records accepted and dropped (its own dead letter included), whether it failed, and whether only now."""
    rows = [(r["path"], r["kind"], r["rows"], r["error"] is not None, r["path"] in gone) for r in found]
    schema = "file_path string, format string, promised bigint, closed boolean, gone boolean"
    listed = spark.createDataFrame(rows, schema)
    none = F.lit(0).cast("bigint")
    counts = counts_per_file(judged)
    refused = judged.filter(F.col("error_code") == FILE_READ_ERROR).select("file_path").distinct()
    joined = (
        listed.join(counts, "file_path", "left")
        .join(refused.withColumn("refused", F.lit(True)), "file_path", "left")
        .withColumns({
            "accepted": F.coalesce("accepted", none), "dropped": F.coalesce("dropped", none),
            "closed": F.col("closed") | F.coalesce("refused", F.lit(False)),
        })
    )
    short = F.coalesce(F.col("accepted") + F.col("dropped") < F.col("promised"), F.lit(False))
    lost = ~F.col("closed") & (short | F.col("gone"))
    return joined.select(
        "file_path",
        "format",
        "accepted",
        (F.col("dropped") + lost.cast("bigint")).alias("dropped"),
        (F.col("closed") | lost).alias("failed"),
        lost.alias("lost"),
    )
