"""The whole gate on a stream, with the baselines of the spike check in a versioned table.

Every micro-batch is judged by the batch operators, so a key may span tasks, rejected records and raw texts never
pass through Python, and order and memory are those of a batch.  Batch ``n`` starts from the newest version of the
baselines before ``n`` and writes both outputs and version ``n`` below folders of its own, with overwrite: a batch
that is repeated after a failure or a restart gives the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pointgate.operators.gate import apply_checks
from pointgate.operators.spike import continue_spikes
from pointgate.options import GateOptions, OutputOptions
from pointgate.plans.run import run_clock
from pointgate.session import folder_names, remove_folder, scratch
from pointgate.sinks.write import quarantine_unwritable, write_both

VERSION = "key string, state array<double>, batch bigint"
#: Versions that stay besides the newest one: a batch that is repeated needs the one before it.
KEPT = 2


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a baseline table, oldest first."""
    return sorted(int(name[6:]) for name in folder_names(spark, path, "_SUCCESS") if name.startswith("batch="))


def baselines_before(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """The newest version before a micro-batch."""
    older = [v for v in versions(spark, path) if v < batch]
    return spark.read.schema(VERSION).parquet(f"{path}/batch={older[-1]}") if older else None


def carried_on(before: DataFrame | None, after: DataFrame, batch: int, keep_batches: int | None) -> DataFrame:
    """The baselines after a micro-batch: those it moved, and the others as they were."""
    moved = after.select("key", "state", F.lit(batch).cast("long").alias("batch"))
    if before is None:
        return moved
    rest = before.join(moved.select(F.col("key").alias("moved")), F.col("key").eqNullSafe(F.col("moved")), "left_anti")
    if keep_batches is not None:
        rest = rest.filter(F.col("batch") >= batch - keep_batches)
    return moved.unionByName(rest)


def start_gate(
    points: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str],
    order: Sequence[str],
    accepted_path: str,
    dead_letter_path: str,
    baseline_path: str,
    checkpoint: str,
    field_count: int,
    output: OutputOptions,
    as_of_ms: int | None = None,
    every: str | None = None,
    keep_batches: int | None = None,
    dead_letter_text: bool = True,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    **spike_options,
) -> StreamingQuery:
    """Judge a stream of points; outputs below ``batch=<id>``, baselines in ``baseline_path``.

    Rows of a micro-batch are put in ``order`` per key; across micro-batches arrival decides.  ``keep_batches``
    forgets keys without a record for that many micro-batches.  ``every`` as in ``streaming.run.start``.  Without
    ``as_of_ms`` each micro-batch reads the clock once.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, now = batch.sparkSession, run_clock(as_of_ms)
        with scratch(spark):
            judged = apply_checks(batch, opts, now, field_count)
            before = after = None
            if opts.spikes_active:
                before = baselines_before(spark, baseline_path, number)
                judged, after = continue_spikes(judged, opts, key, order, before, **spike_options)
            judged = quarantine_unwritable(judged, output, field_count)
            write_both(
                judged, f"{accepted_path}/batch={number}", f"{dead_letter_path}/batch={number}", field_count, output,
                opts, now, "overwrite", dead_letter_text,
            )
            if on_batch is not None:
                on_batch(judged, number)
            if after is not None:
                made = carried_on(before, after, number, keep_batches)
                made.write.mode("overwrite").parquet(f"{baseline_path}/batch={number}")
                for old in versions(spark, baseline_path)[: -1 - KEPT]:
                    remove_folder(spark, f"{baseline_path}/batch={old}")

    writer = points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
