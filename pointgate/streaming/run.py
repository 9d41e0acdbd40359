"""Starting and bounding stream runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pointgate.operators.counts import observe_outcomes
from pointgate.operators.gate import apply_checks
from pointgate.options import GateOptions, OutputOptions
from pointgate.session import scratch
from pointgate.sinks.write import quarantine_unwritable, write_both
from pointgate.streaming.spikes import stream_spikes


def gate_stream(
    points: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    as_of_ms: int | None = None,
    width: int | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """The whole gate on a stream of points.  Late and early records are judged by the clock, not a watermark."""
    checked = apply_checks(points, opts, as_of_ms, width)
    return checked if key is None else stream_spikes(checked, opts, key, order, ttl_ms)


def start(
    gated: DataFrame,
    accepted_path: str,
    dead_letter_path: str,
    checkpoint: str,
    field_count: int,
    output: OutputOptions,
    gate: GateOptions | None = None,
    as_of_ms: int | None = None,
    every: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Write accepted and rejected records of every micro-batch below ``batch=<id>`` folders.

    A repeated micro-batch overwrites its own folder, so a restart never doubles records.  ``every`` is a
    processing-time interval; without it the run takes what is there and ends (batch mode).  Counters are in
    the query's progress under ``outcomes``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            write_both(
                batch,
                f"{accepted_path}/batch={batch_id}",
                f"{dead_letter_path}/batch={batch_id}",
                field_count,
                output,
                gate,
                as_of_ms,
                mode="overwrite",
            )
        if on_batch is not None:
            on_batch(batch, batch_id)

    gated = quarantine_unwritable(gated, output, field_count)  # counted as it is written
    writer = observe_outcomes(gated, "outcomes").writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_for(query: StreamingQuery, max_duration_sec: int | None) -> bool:
    """Wait for the end, or stop after the time limit.  True when the query ended by itself."""
    if max_duration_sec is None:
        query.awaitTermination()
        return True
    ended = query.awaitTermination(max_duration_sec)
    if not ended:
        query.stop()
    return bool(ended)
