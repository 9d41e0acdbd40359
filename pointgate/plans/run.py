"""One batch run from points to both outputs."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation

from pointgate.operators.counts import observe_outcomes
from pointgate.operators.gate import abort_on_read_error, apply_checks
from pointgate.operators.limits import limit_accepted
from pointgate.operators.spike import apply_spikes
from pointgate.options import GateOptions, LimitOptions, OutputOptions
from pointgate.session import scratch, staged
from pointgate.sinks.commit import Outputs, commit_run
from pointgate.sinks.write import quarantine_unwritable, write_both


def run_clock(as_of_ms: int | None) -> int:
    """One clock reading for a whole run: its jobs (limit, both outputs) must not judge by different times."""
    return int(time.time() * 1000) if as_of_ms is None else as_of_ms


def gate_points(
    points: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    as_of_ms: int | None = None,
    width: int | None = None,
    limits: LimitOptions | None = None,
    **spike_options,
) -> DataFrame:
    """The whole gate on a table of points: stateless checks, spikes per ``key``, the record limit.

    With spikes or a limit the points are decoded and checked once, into a staged table (``session.scratch`` says when
    it goes); without, nothing is staged.
    """
    as_of_ms = run_clock(as_of_ms)
    gated = apply_checks(abort_on_read_error(points, opts), opts, as_of_ms, width)
    if key is not None:
        gated = apply_spikes(gated, opts, key, order, **spike_options)
    if limits is not None and limits.max_records is not None:
        gated = limit_accepted(staged(gated, "gated"), limits.max_records, order)
    return gated


def run_batch(
    points: DataFrame,
    opts: GateOptions,
    output: OutputOptions,
    accepted_path: str,
    dead_letter_path: str,
    field_count: int,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    as_of_ms: int | None = None,
    limits: LimitOptions | None = None,
    **spike_options,
) -> dict[str, int]:
    """Gate a table of points, write both outputs, return the counters of what was written.

    Appends to both outputs; ``run_committed`` makes them visible together and can be repeated.
    """
    as_of_ms = run_clock(as_of_ms)
    with scratch(points.sparkSession):
        gated = gate_points(points, opts, key, order, as_of_ms, field_count, limits, **spike_options)
        gated = quarantine_unwritable(gated, output, field_count)
        outcomes = Observation("outcomes")
        write_both(
            observe_outcomes(gated, outcomes), accepted_path, dead_letter_path, field_count, output, opts, as_of_ms
        )
        return dict(outcomes.get)


def run_committed(
    points: DataFrame,
    opts: GateOptions,
    output: OutputOptions,
    outputs: Outputs,
    run_id: str,
    field_count: int,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    as_of_ms: int | None = None,
    limits: LimitOptions | None = None,
    dead_letter_text: bool = True,
    **spike_options,
) -> dict[str, int]:
    """``run_batch`` under a run id: both outputs appear with the run's row in the manifest, however often it is tried."""
    as_of_ms = run_clock(as_of_ms)
    with scratch(points.sparkSession):
        gated = gate_points(points, opts, key, order, as_of_ms, field_count, limits, **spike_options)
        return commit_run(gated, outputs, run_id, field_count, output, opts, as_of_ms, dead_letter_text)
