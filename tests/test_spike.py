import math
import random

import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.operators import spike
from pointgate.operators.gate import VERDICT_FIELDS
from pointgate.options import GateOptions

BIG = 10**15


def opts(limits, **changes):
    return GateOptions(future_tolerance_ms=BIG, stale_tolerance_ms=BIG, spike_max_delta=limits, **changes)


def brute(rows, limits, alpha=0.05):
    """One pass in order, straight from the rule: (id -> (metric, delta, baseline)) of rejected rows."""
    state, out = {}, {}
    for row_id, key, _, metrics in sorted(rows, key=lambda r: (r[2], r[0])):
        base = state.setdefault(key, {})
        for metric in sorted(limits):
            if metrics is None or metric >= len(metrics) or metrics[metric] is None:
                continue
            value = metrics[metric]
            if metric in base and base[metric] > 0 and abs(value - base[metric]) > limits[metric]:
                out[row_id] = (metric, abs(value - base[metric]), base[metric])
                break
            base[metric] = value if metric not in base else alpha * value + (1 - alpha) * base[metric]
    return out


def frame(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "id int, key string, seq bigint, metrics array<double>").repartition(parts)
    df = df.withColumn("status", F.when(F.col("metrics").isNull(), F.lit(P.REJECTED)).otherwise(F.lit(P.ACCEPTED)))
    kinds = {"reason_code": "string", "metric_idx": "int", "observed": "double", "limit_value": "double", "baseline": "double"}
    return df.withColumns({name: F.lit(None).cast(kinds[name]) for name in VERDICT_FIELDS})


def found(df):
    rows = df.collect()
    assert all((r.status == P.REJECTED) == (r.reason_code == P.SPIKE or r.metrics is None) for r in rows)
    return {r.id: (r.metric_idx, r.observed, r.baseline) for r in rows if r.reason_code == P.SPIKE}, len(rows)


WAYS = [{"max_key_rows": None}, {"max_key_rows": 10, "partitions": 6}, {"max_key_rows": 1, "partitions": 23}]


def check(spark, rows, limits, alpha=None):
    want = brute(rows, limits, 0.05 if alpha is None else alpha)
    for way in WAYS:
        options = opts(limits, ema_alpha=alpha)
        got, count = found(spike.apply_spikes(frame(spark, rows), options, "key", ["seq", "id"], **way))
        assert count == len(rows), way
        assert got == want, way
    return want


def series(values, key="a", start=0):
    return [(start + i, key, start + i, [float(v)]) for i, v in enumerate(values)]


def test_hand_computed(spark):
    # 100 sets the baseline; 106 is within 10: 0.5*106+0.5*100=103; 120 is 17 away; 110 is 7 away
    want = check(spark, series([100, 106, 120, 110]), {0: 10.0}, alpha=0.5)
    assert want == {2: (0, 17.0, 103.0)}


def test_lasting_shift_is_rejected_for_good(spark):
    want = check(spark, series([10] * 20 + [100] * 60), {0: 5.0})
    assert len(want) == 60
    assert all(base == pytest.approx(10.0) for _, _, base in want.values())


def test_baseline_not_above_zero_never_rejects(spark):
    assert check(spark, series([-5, 900, -900, 400]), {0: 1.0}, alpha=1.0) == {2: (0, 1800.0, 900.0), 3: (0, 500.0, 900.0)}
    assert check(spark, series([0, 500]), {0: 1.0}) == {}


def test_limit_is_exclusive(spark):
    assert check(spark, series([10, 15]), {0: 5.0}) == {}


def test_earlier_metrics_keep_their_update(spark):
    rows = [(0, "a", 0, [10.0, 10.0]), (1, "a", 1, [20.0, 99.0]), (2, "a", 2, [27.0, 10.0])]
    # Row 1: metric 0 moves to 15 before metric 1 rejects; row 2 is then 12 from 15.
    assert check(spark, rows, {0: 11.0, 1: 5.0}, alpha=0.5) == {1: (1, 89.0, 10.0), 2: (0, 12.0, 15.0)}


def test_rejected_rows_take_no_part(spark):
    rows = series([10] * 5) + [(50, "a", 2, None), (51, None, 3, None)]
    assert check(spark, rows, {0: 1.0}) == {}


def test_short_points(spark):
    rows = [(0, "a", 0, [5.0, 1.0]), (1, "a", 1, [5.0]), (2, "a", 2, [5.0, 9.0])]
    assert check(spark, rows, {1: 2.0}) == {2: (1, 8.0, 1.0)}


def test_nan_baseline_never_rejects(spark):
    rows = series([10.0, math.nan, 500.0, 900.0])
    assert check(spark, rows, {0: 1.0}) == {}


def test_null_keys_are_one_key(spark):
    rows = [(i, None, i, [float(v)]) for i, v in enumerate([10, 11, 50, 10])]
    assert set(check(spark, rows, {0: 5.0})) == {2}


@pytest.mark.parametrize("seed", range(4))
def test_random_series(spark, seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for key, count in (("a", 300), ("b", 60), ("c", 3), ("d", 1), (None, 40)):
        level = rng.uniform(5, 50)
        for _ in range(count):
            level = level + rng.uniform(-3, 3) if rng.random() < 0.97 else rng.uniform(-20, 120)
            rows.append((n, key, rng.randrange(1000), [level + rng.uniform(-9, 9), rng.uniform(0, 30)]))
            n += 1
    assert check(spark, rows, {0: 12.0, 1: 14.0})


def test_two_lasting_levels(spark):
    """Baselines that stay apart: the guesses of the split way go wrong and must be repeated."""
    rng = random.Random(3)
    values = [rng.choice([10, 200]) + rng.random() for _ in range(400)]
    check(spark, series(values), {0: 30.0})


def test_frozen_baseline_over_many_chunks(spark):
    values = [10.0] * 30 + [500.0 + i for i in range(300)] + [11.0] * 30 + [400.0] * 100
    check(spark, series(values), {0: 30.0})


def test_several_key_columns(spark):
    rows = [(i, f"k{i % 2}", i, [float(v)]) for i, v in enumerate([10, 500, 11, 501, 90, 400])]
    df = frame(spark, rows).withColumn("other", F.col("key"))
    got, _ = found(spike.apply_spikes(df, opts({0: 20.0}), ["key", "other"], ["seq"]))
    assert set(got) == set(brute(rows, {0: 20.0}))


def test_stage_is_left_out_when_it_cannot_reject(spark):
    df = frame(spark, series([1, 2]))
    for options in (opts({}), opts({0: 1.0}, fail_fast=False), opts({0: 1.0}, replay_mode=True)):
        assert spike.apply_spikes(df, options, "key", ["seq"]) is df


def test_one_shuffle_for_small_keys(spark):
    df = spark.range(100).selectExpr("cast(id as int) id", "'a' key", "id seq", "array(cast(id as double)) metrics")
    df = df.selectExpr("*", "'accepted' status", "cast(null as string) reason_code", "cast(null as int) metric_idx",
                       "cast(null as double) observed", "cast(null as double) limit_value", "cast(null as double) baseline")
    out = spike.apply_spikes(df, opts({0: 5.0}), "key", ["seq"])
    assert out._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1


@pytest.mark.parametrize("levels", [(100.0,), (10.0, 400.0)])
def test_slow_average_over_many_chunks_needs_few_jobs(spark, monkeypatch, levels):
    """Baselines that do not forget their start within a chunk: three rounds, then one ordered walk."""
    rng = random.Random(8)
    rows = series([rng.choice(levels) + rng.random() for _ in range(1200)])
    rows += [(5000 + i, None, i, [50.0 + rng.random()]) for i in range(300)]
    rows += [(9000 + i, "c", i, [20.0 + 40 * rng.random()]) for i in range(9)]
    rounds, learn = [], spike._Chain.learn
    monkeypatch.setattr(spike._Chain, "learn", lambda *a: (rounds.append(1), learn(*a)))
    options = opts({0: 30.0}, ema_alpha=0.001)
    out = spike.apply_spikes(frame(spark, rows), options, "key", ["seq", "id"], partitions=24, max_key_rows=100)
    got, count = found(out)
    assert (got, count) == (brute(rows, {0: 30.0}, 0.001), len(rows))
    assert len(rounds) <= 3


class Chunks:
    """A row of a chunk summary."""

    def __init__(self, chunk, first, last, candidate, end):
        self.chunk, self.first_key, self.last_key, self.candidate, self.end = chunk, first, last, candidate, end


def test_chain_settles_a_chunk_per_round_at_worst():
    """Chunks that map every start to start + 1: no guess is right by luck."""
    chain = spike._Chain(1)
    rows = [Chunks(0, "z", "a", 0, [0.0])] + [Chunks(i, "a", "a", 0, [1000.0 + i]) for i in range(1, 8)]
    chain.learn(rows, {})
    starts, todo = chain.resolve()
    while todo:
        assert chain.rounds < 10
        rows = [Chunks(c, "a", "a", i, [(g[0] or 0.0) + 1.0]) for c, gs in todo.items() for i, g in enumerate(gs)]
        chain.learn(rows, todo)
        starts, todo = chain.resolve()
    assert [starts[c] for c in range(1, 8)] == [[float(c - 1)] for c in range(1, 8)]


def test_ranges_follow_the_rows_not_the_size_of_a_big_key(spark, monkeypatch):
    """A task per ``max_key_rows`` rows would be thousands of tiny ones."""
    asked, by_range = [], spike._by_range
    monkeypatch.setattr(spike, "_by_range", lambda *a: asked.append(a[-1]) or by_range(*a))
    rng = random.Random(3)
    rows = series([rng.choice((10.0, 90.0)) + rng.random() for _ in range(200)])
    got, count = found(spike.apply_spikes(frame(spark, rows), opts({0: 30.0}), "key", ["seq", "id"], max_key_rows=2))
    assert (got, count) == (brute(rows, {0: 30.0}), len(rows))
    assert asked == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
