"""The spike check on a stream: baselines live in the state store, one value per key."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pointgate.operators import points as P
from pointgate.operators.spike import _OUT, _VALUE, _merge, _prepared, walk
from pointgate.options import GateOptions

# Names in front of pandas: it cannot take column names that start with an underscore.
_GROUP, _ORDER, _METRIC, _ABSENT, _CARRIED = "spike_group", "spike_order{}", "spike_value{}", "spike_absent{}", "carried{}"
_EXACT = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)
_REJECTED_GROUPS = 1024
#: Rows that are walked at once.
_STEP_ROWS = 20_000


class _SpikeProcessor(StatefulProcessor):
    def __init__(self, thresholds: list[tuple[int, float]], alpha: float, orders: int, carried: int, ttl_ms: int | None):
        self.thresholds, self.alpha, self.ttl_ms = thresholds, alpha, ttl_ms
        self.order = [_ORDER.format(i) for i in range(orders)]
        self.carried = [_CARRIED.format(i) for i in range(carried)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("baselines", T.ArrayType(T.DoubleType()))])
        self.state = handle.getValueState("baselines", schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows of one key and micro-batch: what is only carried waits in a local file, order and values stay as arrays.
        slots = range(len(self.thresholds))
        orders, values, absent, sizes = [], [[] for _ in slots], [[] for _ in slots], []
        with tempfile.TemporaryFile() as waiting:
            for part in rows:
                pickle.dump(part[self.carried], waiting, pickle.HIGHEST_PROTOCOL)
                orders.append(part[self.order].copy())
                sizes.append(len(part))
                for s in slots:
                    values[s].append(part[_METRIC.format(s)].to_numpy(float, copy=True))
                    absent[s].append(part[_ABSENT.format(s)].to_numpy(bool, copy=True))
            place = pd.concat(orders, ignore_index=True).sort_values(self.order, kind="stable").index.to_numpy()
            del orders
            hits = self._hits(place, [np.concatenate(v) for v in values], [np.concatenate(a) for a in absent])
            waiting.seek(0)
            begin = 0
            for size in sizes:
                carried = pickle.load(waiting).reset_index(drop=True)
                low, high = np.searchsorted(hits["row"], [begin, begin + size])
                own = hits.iloc[low:high]
                found = own.assign(row=own["row"] - begin).set_index("row").reindex(carried.index)
                found["__hit_metric"] = found["__hit_metric"].astype("Int32")
                yield pd.concat([carried, found], axis=1)
                begin += size

    def _hits(self, place: np.ndarray, values: list[np.ndarray], absent: list[np.ndarray]) -> pd.DataFrame:
        """The rejected rows by their place of arrival; ``place`` lists the places in order."""
        stored = self.state.get() if self.state.exists() else None
        state = [None] * len(self.thresholds) if stored is None else list(stored[0])
        before, found = list(state), []
        for begin in range(0, len(place), _STEP_ROWS):
            some = place[begin : begin + _STEP_ROWS]
            columns = [[None if a else v for v, a in zip(v[some].tolist(), a[some])] for v, a in zip(values, absent)]
            hits: list[tuple[int, int, float, float]] = []
            walk(columns, 0, len(some), self.thresholds, self.alpha, state, hits)
            part = pd.DataFrame(hits, columns=["row", *_OUT.names])
            found.append(part.assign(row=some[part["row"].to_numpy(int)]))
        if state != before:
            self.state.update((state,))
        return pd.concat(found, ignore_index=True).sort_values("row", ignore_index=True)

    def close(self) -> None:
        pass


def stream_spikes(
    df: DataFrame,
    opts: GateOptions,
    key: str | Sequence[str],
    order: Sequence[str],
    ttl_ms: int | None = None,
) -> DataFrame:
    """``operators.spike.apply_spikes`` for streams.

    Rows of a micro-batch are put in ``order`` per key; across micro-batches arrival decides.  ``ttl_ms``
    forgets a key's baselines after that time without change.  Keep micro-batches small enough for a key's
    share with maxFilesPerTrigger or maxOffsetsPerTrigger.  ``order`` columns may not be null.
    """
    if not opts.spikes_active:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    thresholds = sorted((int(i), float(d)) for i, d in opts.spike_max_delta.items())
    fields = df.schema.fields
    rows = _prepared(df, keys, thresholds)
    text_key = F.col("__spike_key")
    own = F.concat(F.lit("key-"), text_key.isNull().cast("string"), F.coalesce(text_key, F.lit("")))
    # Rejected rows keep no state; they are spread so that they never gather on one task.
    spread = F.concat(F.lit("rejected-"), F.pmod(F.hash(*order), F.lit(_REJECTED_GROUPS)).cast("string"))
    values = [F.col(_VALUE.format(s)) for s in range(len(thresholds))]
    # Whole numbers travel as text: pandas would turn a column with nulls into doubles.
    exact = [isinstance(f.dataType, _EXACT) for f in fields]
    carried = [F.col(f"`{f.name}`").cast("string") if e else F.col(f"`{f.name}`") for f, e in zip(fields, exact)]
    rows = rows.select(
        F.when(F.col("status") == P.ACCEPTED, own).otherwise(spread).alias(_GROUP),
        *[F.col(f"`{name}`").alias(_ORDER.format(i)) for i, name in enumerate(order)],
        *[F.coalesce(v, F.lit(0.0)).alias(_METRIC.format(s)) for s, v in enumerate(values)],
        *[v.isNull().alias(_ABSENT.format(s)) for s, v in enumerate(values)],
        *[c.alias(_CARRIED.format(i)) for i, c in enumerate(carried)],
    )
    back = [
        T.StructField(_CARRIED.format(i), T.StringType() if e else f.dataType)
        for i, (f, e) in enumerate(zip(fields, exact))
    ]
    decided = rows.groupBy(_GROUP).transformWithStateInPandas(
        _SpikeProcessor(thresholds, opts.alpha, len(order), len(fields), ttl_ms),
        T.StructType(back + _OUT.fields),
        "Append",
        "None" if ttl_ms is None else "ProcessingTime",
    )
    restored = [F.col(_CARRIED.format(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return _merge(decided.select(*restored, *_OUT.names), thresholds)
