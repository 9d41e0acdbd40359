"""Runs that commit both outputs with one manifest row, evaluate their source once and leave no scratch folder."""

import os

import pytest
from pyspark.sql import functions as F

from pointgate import session
from pointgate.operators.gate import apply_checks
from pointgate.operators.spike import apply_spikes, continue_spikes
from pointgate.options import Bound, GateOptions, LimitOptions, OutputOptions
from pointgate.plans.run import run_batch, run_committed
from pointgate.sinks import commit
from pointgate.sinks.commit import Outputs, committed_runs, read_accepted, read_dead_letter

NOW = 1_700_000_000_000
GATE = GateOptions(10**15, 10**15, bounds={0: Bound(max=80.0)}, spike_max_delta={0: 30.0})


def points(spark, count=300, counted=None):
    df = spark.range(0, count, 1, 3).selectExpr(
        "id", "id % 4 as key", f"({NOW} + id) * 1000000 timestamp_ns", "array(cast(id * 7 % 90 as double), 1.0D) metrics",
        "cast(null as string) feed", "cast(id as string) raw", "cast(null as string) parse_error",
        "cast(null as string) error_code", "null as nothing",
    )
    if counted is None:
        return df

    def count_rows(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    return df.drop("nothing").mapInArrow(count_rows, df.drop("nothing").schema)


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """A shared folder of its own for one test."""
    before = session.shared_dir(spark)
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    yield tmp_path / "shared"
    spark.sparkContext.setCheckpointDir(before)


def files_below(root):
    return [f"{base}/{name}" for base, _, names in os.walk(root) for name in names]


@pytest.mark.parametrize("step", ["write_accepted", "write_dead_letter", "outcome_counts"])
def test_failed_run_is_invisible_and_repeated_without_doubles(spark, tmp_path, monkeypatch, step):
    outputs, form = Outputs(str(tmp_path / "out")), OutputOptions(format="csv")
    go = lambda run: run_committed(points(spark), GATE, form, outputs, run, 2, "key", ["id"], NOW)
    first = go("a")

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commit, step, lost)
        with pytest.raises(OSError):
            go("b")
    assert [r.run_id for r in committed_runs(spark, outputs).collect()] == ["a"]
    assert read_accepted(spark, outputs, form).count() == first["accepted"]
    for _ in range(2):
        assert go("b") == first
    assert read_accepted(spark, outputs, form).count() == 2 * first["accepted"] > 0
    dead = read_dead_letter(spark, outputs, form)
    assert dead.count() == 2 * first["dropped"] > 0 and {r.run for r in dead.collect()} == {"a", "b"}
    assert first["accepted"] + first["dropped"] == 300


def test_nothing_is_committed_yet(spark, tmp_path):
    outputs = Outputs(str(tmp_path / "none"))
    assert committed_runs(spark, outputs).count() == 0 and read_accepted(spark, outputs, OutputOptions()) is None
    with pytest.raises(ValueError):
        run_committed(points(spark), GATE, OutputOptions(), outputs, "a/b", 2, None, ["id"], NOW)


def test_source_is_decoded_once_for_limit_spikes_and_both_outputs(spark, tmp_path, folder):
    counted = spark.sparkContext.accumulator(0)
    outputs = Outputs(str(tmp_path / "out"))
    source = points(spark, counted=counted)
    for limit in (LimitOptions(max_records=50), None):
        counted.value = 0
        done = run_committed(source, GATE, OutputOptions(), outputs, "a", 2, "key", ["id"], NOW, limit, max_key_rows=20)
        assert counted.value == 300 and done["accepted"] == (50 if limit else done["accepted"])
    assert files_below(folder) == []  # staged tables and checkpoints are gone


def test_scratch_of_a_batch_run_is_deleted(spark, tmp_path, folder):
    run_batch(points(spark), GATE, OutputOptions(format="csv"), str(tmp_path / "a"), str(tmp_path / "d"), 2, "key", ["id"], NOW)
    assert files_below(folder) == [] and files_below(tmp_path / "a")


def test_nested_blocks_keep_the_outer_tables(spark, folder):
    with session.scratch(spark):
        outer = session.staged(spark.range(5).withColumn("nothing", F.lit(None)), "outer")
        with session.scratch(spark):
            session.staged(spark.range(3), "inner").count()
        assert [r.nothing for r in outer.collect()] == [None] * 5 and outer.columns == ["id", "nothing"]
    assert files_below(folder) == []


@pytest.mark.parametrize("way", [{"max_key_rows": 1000}, {"max_key_rows": 5, "partitions": 7}])
def test_spikes_go_on_from_given_baselines(spark, way):
    """Records judged in three parts, the baselines handed on, are judged as in one."""
    whole = apply_checks(points(spark).withColumn("key", F.when(F.col("id") % 9 > 0, F.col("key"))), GATE, NOW, 2)
    want = {r.id: (r.status, r.baseline) for r in apply_spikes(whole, GATE, "key", ["id"]).collect()}
    got, state = {}, None
    for low, high in ((0, 40), (40, 41), (41, 300)):
        part = whole.filter(F.col("id").between(low, high - 1))
        judged, state = continue_spikes(part, GATE, "key", ["id"], state, **way)
        got |= {r.id: (r.status, r.baseline) for r in judged.collect()}
    assert got == want and {s for s, _ in want.values()} == {"accepted", "rejected"}
