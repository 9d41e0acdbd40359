"""The stateful check: a sudden change against an exponential moving average per key and metric.

A value further than ``max_delta`` from a positive baseline rejects the record and leaves the baselines of
that and all later metrics as they were; any other value moves its baseline.  Whether a value moves the
baseline depends on the baseline, so the records of one key form one sequence.

* Usual case: hash the rows by key, sort within partitions, walk them once.  One shuffle, constant memory.
* The checked records are staged once.  Only the accepted ones' key, order and values are shuffled and reach Python;
  the hits, which are few, are joined to the staged records by their number.
* Keys with more rows than ``max_key_rows``: range-partition their rows by (key, order) so that a big key
  spans many partitions, walk all partitions at once from guessed baselines, and repeat only the partitions
  whose guess turns out wrong.  A guess counts as right only if it equals the baseline its predecessor really
  ends with, so the result is exactly the sequential one.  Baselines forget their start, so two or three
  rounds are normal.  What is open after ``_ROUNDS`` rounds (slow averages, baselines frozen at two levels) is
  walked in order in one more job, a task per key that streams its values.  All other keys go the usual way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointgate.operators import points as P
from pointgate.options import GateOptions
from pointgate.session import checkpointed, staged

State = tuple[float | None, ...]

_VALUE = "__spike_value_{}"
_KEY = "__spike_key"
_CHUNK = "__spike_chunk"
_ROW = "__spike_row"
_STATE = "__spike_state"
_ROUNDS = 3
#: A range of fewer rows is not worth a task: partitions stream their rows, so a big one costs no memory.
_RANGE_ROWS = 250_000
_OUT = T.StructType(
    [
        T.StructField("__hit_metric", T.IntegerType()),
        T.StructField("__hit_delta", T.DoubleType()),
        T.StructField("__hit_baseline", T.DoubleType()),
    ]
)
_FOUND = T.StructType(
    [T.StructField(_ROW, T.LongType()), *_OUT.fields, T.StructField(_KEY, T.StringType()),
     T.StructField(_CHUNK, T.IntegerType()), T.StructField(_STATE, T.ArrayType(T.DoubleType()))]
)
_SUMMARY = T.StructType(
    [
        T.StructField("chunk", T.IntegerType()),
        T.StructField("first_key", T.StringType()),
        T.StructField("last_key", T.StringType()),
        T.StructField("candidate", T.IntegerType()),
        T.StructField("end", T.ArrayType(T.DoubleType())),
    ]
)


def walk(
    columns: Sequence[Sequence[float | None]],
    begin: int,
    end: int,
    thresholds: Sequence[tuple[int, float]],
    alpha: float,
    state: list[float | None],
    hits: list[tuple[int, int, float, float]] | None = None,
) -> None:
    """Step ``state`` over rows [begin, end); append (row, metric, delta, baseline) of rejected ones."""
    keep = 1.0 - alpha
    if len(thresholds) == 1:
        metric, limit = thresholds[0]
        values, base = columns[0], state[0]
        for row in range(begin, end):
            value = values[row]
            if value is None:
                continue
            if base is None:
                base = value
            elif base > 0.0 and abs(value - base) > limit:
                if hits is not None:
                    hits.append((row, metric, abs(value - base), base))
            else:
                base = (alpha * value) + (keep * base)
        state[0] = base
        return
    for row in range(begin, end):
        for slot, (metric, limit) in enumerate(thresholds):
            value = columns[slot][row]
            if value is None:
                continue
            base = state[slot]
            if base is None:
                state[slot] = value
            elif base > 0.0 and abs(value - base) > limit:
                if hits is not None:
                    hits.append((row, metric, abs(value - base), base))
                break
            else:
                state[slot] = (alpha * value) + (keep * base)


def _runs(keys: pa.Array) -> list[tuple[int, int, str | None]]:
    """Stretches of equal adjacent keys: (begin, end, key)."""
    if len(keys) == 0:
        return []
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
    return [(b, e, keys[b].as_py()) for b, e in zip(cuts, cuts[1:])]


def _value_lists(batch: pa.RecordBatch, slots: int) -> list[list[float | None]]:
    columns = [_column(batch, _VALUE.format(slot)) for slot in range(slots)]
    return [c.to_pylist() if c.null_count else c.to_numpy(zero_copy_only=False).tolist() for c in columns]


def _hit_columns(hits: list[tuple[int, int, float, float]], rows: int) -> list[pa.Array]:
    """The hit columns of a batch: null but for the rejected rows."""
    absent = np.ones(rows, bool)
    columns = [np.zeros(rows, np.int32), np.zeros(rows), np.zeros(rows)]
    if hits:
        row, *found = zip(*hits)
        absent[list(row)] = False
        for column, values in zip(columns, found):
            column[list(row)] = values
    return [pa.array(column, mask=absent) for column in columns]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _decide(thresholds, alpha, kept: list[str], starts: dict[int, list[float | None]] | None = None):
    """Task body: add the hit columns.  ``starts`` gives the baselines a chunk's first key begins with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, first = None, [None] * len(thresholds), True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if first and starts is not None:
                state = list(starts.get(_column(batch, _CHUNK)[0].as_py()) or state)
            columns = _value_lists(batch, len(thresholds))
            hits: list[tuple[int, int, float, float]] = []
            for begin, end, run_key in _runs(_column(batch, _KEY)):
                if not first and run_key != key:
                    state = [None] * len(thresholds)
                key, first = run_key, False
                walk(columns, begin, end, thresholds, alpha, state, hits)
            yield pa.RecordBatch.from_arrays(
                [_column(batch, name) for name in kept] + _hit_columns(hits, batch.num_rows),
                names=[*kept, *_OUT.names],
            )

    return run


def _find(thresholds, alpha, starts: dict[int, list[float | None]] | None = None, ends: bool = False):
    """Task body: the rejected rows by number with their hit columns and, with ``ends``, the baselines that each key
    of the partition ends with.  ``starts`` as in ``_decide``."""

    def some(rows, hits, keys, chunks, states) -> pa.RecordBatch:
        metric, delta, baseline = zip(*hits) if hits else ((), (), ())
        none = [None] * len(keys)
        return pa.RecordBatch.from_pydict(
            {
                _ROW: pa.array([*rows, *none], pa.int64()),
                "__hit_metric": pa.array([*metric, *none], pa.int32()),
                "__hit_delta": pa.array([*delta, *none], pa.float64()),
                "__hit_baseline": pa.array([*baseline, *none], pa.float64()),
                _KEY: pa.array([None] * len(rows) + keys, pa.string()),
                _CHUNK: pa.array([None] * len(rows) + chunks, pa.int32()),
                _STATE: pa.array([None] * len(rows) + states, pa.list_(pa.float64())),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, first, chunk = None, [None] * len(thresholds), True, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if first and starts is not None:
                chunk = _column(batch, _CHUNK)[0].as_py()
                state = list(starts.get(chunk) or state)
            columns = _value_lists(batch, len(thresholds))
            hits: list[tuple[int, int, float, float]] = []
            done: list[tuple[str | None, list[float | None]]] = []
            for begin, end, run_key in _runs(_column(batch, _KEY)):
                if not first and run_key != key:
                    done.append((key, state))
                    state = [None] * len(thresholds)
                key, first = run_key, False
                walk(columns, begin, end, thresholds, alpha, state, hits)
            if hits or ends and done:
                numbers = _column(batch, _ROW).take(pa.array([h[0] for h in hits], pa.int64())).to_pylist()
                done = done if ends else []
                yield some(numbers, [h[1:] for h in hits], [k for k, _ in done], [chunk] * len(done), [s for _, s in done])
        if ends and not first:
            yield some([], [], [key], [chunk], [state])

    return run


def _summarise(thresholds, alpha, guesses: dict[int, list[list[float | None]]]):
    """Task body: one row per (chunk, guess) with the baselines its last key ends with.

    A chunk with several keys ends with the state of its last key, which began inside: no guess matters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: list[list[float | None]] = []
        chunk = first_key = key = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = _value_lists(batch, len(thresholds))
            for begin, end, run_key in _runs(_column(batch, _KEY)):
                if chunk is None:
                    chunk = _column(batch, _CHUNK)[0].as_py()
                    first_key = run_key
                    states = [list(s) for s in guesses.get(chunk, [[None] * len(thresholds)])]
                elif run_key != key:
                    states = [[None] * len(thresholds)]
                key = run_key
                for state in states:
                    walk(columns, begin, end, thresholds, alpha, state)
        if chunk is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": [chunk] * len(states),
                    "first_key": [first_key] * len(states),
                    "last_key": [key] * len(states),
                    "candidate": list(range(len(states))),
                    "end": states,
                },
                schema=pa.schema(
                    [
                        ("chunk", pa.int32()),
                        ("first_key", pa.string()),
                        ("last_key", pa.string()),
                        ("candidate", pa.int32()),
                        ("end", pa.list_(pa.float64())),
                    ]
                ),
            )

    return run


_STARTS = T.StructType(
    [T.StructField("chunk", T.IntegerType()), T.StructField("start", T.ArrayType(T.DoubleType()))]
)


def _follow(thresholds, alpha, starts: dict[int, list[float | None]]):
    """Task body: walk whole keys chunk by chunk; one row per chunk with the baselines it begins with.

    ``starts`` holds the baselines of the first chunk of each key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = key = None
        state: list[float | None] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = _value_lists(batch, len(thresholds))
            chunks = _column(batch, _CHUNK).to_numpy()
            found: dict[int, list[float | None]] = {}
            for begin, end, run_key in _runs(_column(batch, _KEY)):
                cuts = (np.flatnonzero(np.diff(chunks[begin:end])) + begin + 1).tolist()
                for b, e in zip([begin, *cuts], [*cuts, end]):
                    here = int(chunks[b])
                    if here != chunk or run_key != key:
                        if chunk is None or run_key != key:
                            state = list(starts[here])
                        chunk, key = here, run_key
                        found[here] = list(state)
                    walk(columns, b, e, thresholds, alpha, state)
            yield pa.RecordBatch.from_pydict(
                {"chunk": list(found), "start": list(found.values())},
                schema=pa.schema([("chunk", pa.int32()), ("start", pa.list_(pa.float64()))]),
            )

    return run


def _token(state: Sequence[float | None]) -> tuple:
    """A state as a comparable value, bit for bit (NaN equals NaN, -0.0 differs from 0.0)."""
    return tuple(None if v is None else "nan" if math.isnan(v) else v.hex() for v in state)


class _Chain:
    """Follows baselines from chunk to chunk over the per-chunk summaries.

    Size: one entry per partition of the range shuffle and guess, never per row.
    """

    def __init__(self, slots: int):
        self.none: State = (None,) * slots
        self.keys: dict[int, tuple[str | None, str | None]] = {}
        self.ends: dict[int, dict[tuple, State]] = {}
        self.rounds = 0

    def learn(self, rows, guesses: dict[int, list[list[float | None]]]) -> None:
        self.rounds += 1
        for row in rows:
            self.keys[row.chunk] = (row.first_key, row.last_key)
            used = guesses.get(row.chunk, [list(self.none)])
            self.ends.setdefault(row.chunk, {})[_token(used[row.candidate])] = tuple(row.end)

    def resolve(self) -> tuple[dict[int, list[float | None]], dict[int, list[list[float | None]]]]:
        """(start of every chunk, further guesses to try).  Starts are final once no guess is left."""
        starts: dict[int, list[float | None]] = {}
        todo: dict[int, list[list[float | None]]] = {}
        previous_key: object = object()
        end: State | None = self.none
        certain = self.none  # the last baseline known for sure on this key
        nearby: list[State] = []  # what the predecessor ends with under the guesses tried so far
        for chunk in sorted(self.keys):
            first_key, last_key = self.keys[chunk]
            known = self.ends[chunk]
            same = first_key == previous_key
            start = end if same else self.none
            if not same:
                certain, nearby = self.none, []
            if start is not None:
                starts[chunk] = list(start)
                certain = start
            if first_key != last_key:
                end = next(iter(known.values()))
                certain, nearby = end, []
            elif start is not None and _token(start) in known:
                end = known[_token(start)]
                nearby = []
            else:
                wanted = {_token(s): s for s in ([start] if start is not None else [certain, *nearby])}
                fresh = [list(s) for t, s in wanted.items() if t not in known]
                if fresh:
                    todo[chunk] = fresh
                end = None
                nearby = list({_token(s): s for s in known.values()}.values())
            previous_key = last_key
        return starts, todo


    def open_keys(self, todo) -> dict[str | None, tuple[int, int]]:
        """Keys with open chunks: the first chunk to walk (its start is certain) and the last one that matters."""
        spans: dict[str | None, tuple[int, int]] = {}
        for chunk in sorted(self.keys):
            first_key = self.keys[chunk][0]
            if first_key in spans:
                spans[first_key] = (spans[first_key][0], chunk)
            elif chunk in todo:
                spans[first_key] = (chunk, chunk)
        return spans


def _text_key(keys: Sequence[str]) -> Column:
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def _merge(df: DataFrame, thresholds) -> DataFrame:
    """Turn hits into rejections."""
    hit = F.col("__hit_metric").isNotNull()
    limit = F.lit(None).cast("double")
    for metric, max_delta in thresholds:
        limit = F.when(F.col("__hit_metric") == metric, F.lit(float(max_delta))).otherwise(limit)
    return df.withColumns(
        {
            "status": F.when(hit, F.lit(P.REJECTED)).otherwise(F.col("status")),
            "reason_code": F.when(hit, F.lit(P.SPIKE)).otherwise(F.col("reason_code")),
            "metric_idx": F.when(hit, F.col("__hit_metric")).otherwise(F.col("metric_idx")),
            "observed": F.when(hit, F.col("__hit_delta")).otherwise(F.col("observed")),
            "limit_value": F.when(hit, limit).otherwise(F.col("limit_value")),
            "baseline": F.when(hit, F.col("__hit_baseline")).otherwise(F.col("baseline")),
        }
    ).drop(*_OUT.names)


def _prepared(df: DataFrame, keys: Sequence[str], thresholds) -> DataFrame:
    accepted = F.col("status") == P.ACCEPTED
    values = {
        _VALUE.format(slot): F.when(accepted, F.get("metrics", F.lit(metric)))
        for slot, (metric, _) in enumerate(thresholds)
    }
    return df.withColumns({_KEY: _text_key(keys), **values})


def _by_hash(rows: DataFrame, keys, order, thresholds, alpha, kept, partitions) -> DataFrame:
    # Rejected rows take no part; spreading them by their order keeps e.g. a null key from piling up.
    spread = F.when(F.col("status") == P.ACCEPTED, F.hash(*keys)).otherwise(F.hash(*order))
    shuffled = rows.repartition(partitions, spread) if partitions else rows.repartition(spread)
    placed = shuffled.sortWithinPartitions(_KEY, *order)
    schema = T.StructType([placed.schema[name] for name in kept] + _OUT.fields)
    return placed.mapInArrow(_decide(thresholds, alpha, kept), schema)


def _found_by_hash(narrow: DataFrame, order, thresholds, alpha, ends: bool, partitions) -> DataFrame:
    shuffled = narrow.repartition(partitions, _KEY) if partitions else narrow.repartition(_KEY)
    return shuffled.sortWithinPartitions(_KEY, *order).mapInArrow(_find(thresholds, alpha, None, ends), _FOUND)


def _by_range(rows: DataFrame, order, thresholds, alpha, ends: bool, partitions: int) -> DataFrame:
    # Written to the shared checkpoint folder: later rounds must see the very same partitions, also after
    # an executor is lost, and range bounds are sampled anew on every execution.
    placed = checkpointed(
        rows.repartitionByRange(partitions, _KEY, *order)
        .sortWithinPartitions(_KEY, *order)
        .withColumn(_CHUNK, F.spark_partition_id())
    )
    values = [_VALUE.format(s) for s in range(len(thresholds))]
    narrow = placed.select(_KEY, _CHUNK, *values)
    chain = _Chain(len(thresholds))
    guesses: dict[int, list[list[float | None]]] = {}
    todo: dict[int, list[list[float | None]]] | None = None
    while (todo is None or todo) and chain.rounds < _ROUNDS:
        part = narrow if todo is None else narrow.filter(F.col(_CHUNK).isin(list(todo)))
        guesses = todo or {}
        chain.learn(part.mapInArrow(_summarise(thresholds, alpha, guesses), _SUMMARY).collect(), guesses)
        starts, todo = chain.resolve()
    if todo:
        open_rows = F.lit(False)
        firsts: dict[int, list[float | None]] = {}
        for key, (low, high) in chain.open_keys(todo).items():
            open_rows = open_rows | (F.col(_KEY).eqNullSafe(F.lit(key)) & F.col(_CHUNK).between(low, high))
            firsts[low] = starts[low]
        rest = placed.filter(open_rows).select(_KEY, _CHUNK, *[F.col(c) for c in order], *values)
        rest = rest.repartition(_KEY).sortWithinPartitions(_KEY, _CHUNK, *order).select(_KEY, _CHUNK, *values)
        for row in rest.mapInArrow(_follow(thresholds, alpha, firsts), _STARTS).collect():
            starts[row.chunk] = list(row.start)
    return placed.mapInArrow(_find(thresholds, alpha, starts, ends), _FOUND)


def apply_spikes(
    df: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str],
    order: Sequence[str],
    partitions: int | None = None,
    max_key_rows: int | None = 20_000_000,
) -> DataFrame:
    """Run the spike check on a checked frame (``operators.gate.apply_checks``).

    ``key`` scopes the baselines (a feed, a sensor, a source file); ``order`` must order its rows totally.
    A count per key decides which keys are split; ``max_key_rows=None`` skips the count and always hashes.
    When the check cannot reject anything the frame is returned as it is.
    """
    if not opts.spikes_active:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    thresholds = sorted((int(i), float(d)) for i, d in opts.spike_max_delta.items())
    if max_key_rows is None:
        rows, kept = _prepared(df, keys, thresholds), list(df.columns)
        return _merge(_by_hash(rows, keys, order, thresholds, opts.alpha, kept, partitions), thresholds)
    judged, _ = _staged_spikes(df, opts, keys, order, thresholds, None, False, partitions, max_key_rows)
    return judged


def continue_spikes(
    df: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str],
    order: Sequence[str],
    baselines: DataFrame | None = None,
    partitions: int | None = None,
    max_key_rows: int = 20_000_000,
) -> tuple[DataFrame, DataFrame]:
    """``apply_spikes`` on records that follow others: the judged frame, and the baselines after it.

    ``baselines`` (``key``, ``state``: one value per metric checked, in order of the metrics) is what the records
    before ended with; the second result is the same for those in ``df``, to be carried on.  Keys may span tasks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    thresholds = sorted((int(i), float(d)) for i, d in opts.spike_max_delta.items())
    return _staged_spikes(df, opts, keys, list(order), thresholds, baselines, True, partitions, max_key_rows)


def _staged_spikes(
    df: DataFrame, opts: GateOptions, keys, order, thresholds, baselines: DataFrame | None, ends: bool, partitions,
    max_key_rows: int,
) -> tuple[DataFrame, DataFrame | None]:
    # Decoded and checked once; the counts, the range sample, the shuffle and the result read this copy.
    rows = staged(df.withColumn(_ROW, F.monotonically_increasing_id()), "checked")
    values = [_VALUE.format(s) for s in range(len(thresholds))]
    narrow = _prepared(rows, keys, thresholds).filter(F.col("status") == P.ACCEPTED).select(_ROW, _KEY, *order, *values)
    if baselines is not None:
        # A key's first value becomes its baseline: a row before all others hands the old one on.
        none = F.lit(None)
        before = baselines.select(
            none.cast("long").alias(_ROW), F.col("key").alias(_KEY),
            *[none.cast(rows.schema[name].dataType).alias(name) for name in order],
            *[F.get("state", F.lit(s)).alias(name) for s, name in enumerate(values)],
        )
        narrow = narrow.unionByName(before)
    counts = narrow.groupBy(_KEY).agg(F.count("*").alias("count"))
    is_big = F.col("count") > max_key_rows
    # One row comes back; at most one key per max_key_rows rows is in its list.
    sizes = counts.agg(
        F.sum("count").alias("total"),
        F.coalesce(F.sum(F.when(is_big, F.col("count"))), F.lit(0)).alias("split"),
        F.collect_list(F.when(is_big, F.struct(F.col(_KEY).alias("key")))).alias("big"),
    ).first()
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Enough partitions that none gets much more rows than the biggest key may have.
    small_wanted = math.ceil(((sizes.total or 0) - sizes.split) / max(max_key_rows, _RANGE_ROWS))
    small_parts = partitions or (small_wanted if small_wanted > shuffle else None)
    if not sizes.big:
        found = _found_by_hash(narrow, order, thresholds, opts.alpha, ends, small_parts)
    else:
        named = [row.key for row in sizes.big if row.key is not None]
        split = F.coalesce(F.col(_KEY).isin(named), F.lit(any(row.key is None for row in sizes.big)))
        big_parts = partitions or max(shuffle, math.ceil(sizes.split / max(max_key_rows, _RANGE_ROWS)))
        big = _by_range(narrow.filter(split), order, thresholds, opts.alpha, ends, big_parts)
        found = big.unionByName(_found_by_hash(narrow.filter(~split), order, thresholds, opts.alpha, ends, small_parts))
    after = None
    if ends:
        found = staged(found, "spikes")
        last = found.filter(F.col(_STATE).isNotNull()).groupBy(_KEY).agg(F.max_by(_STATE, _CHUNK).alias("state"))
        after = last.withColumnRenamed(_KEY, "key")
    hits = found.filter(F.col("__hit_metric").isNotNull()).select(_ROW, *_OUT.names)
    merged = _merge(rows.join(hits, _ROW, "left"), thresholds)
    return merged.select(*df.columns), after
