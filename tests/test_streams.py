import json
import random

import pytest
from pyspark.sql import functions as F

from pointgate.operators import points as P
from pointgate.operators.feeds import decode_feed
from pointgate.operators.gate import apply_checks
from pointgate.options import GateOptions, OutputOptions
from pointgate.plans.run import gate_points
from pointgate.sources.messages import read_landed
from pointgate.streaming.baselines import VERSION, carried_on, start_gate, versions
from pointgate.streaming.run import gate_stream, run_for, start

NOW = 1_700_000_000_000
OPTS = GateOptions(future_tolerance_ms=10**12, stale_tolerance_ms=10**13, price_max=900.0, spike_max_delta={0: 20.0, 1: 15.0})


def messages(seed, start_at, count):
    rng = random.Random(seed)
    out = []
    for i in range(start_at, start_at + count):
        price = 100 + rng.uniform(-15, 15) + (rng.random() < 0.1) * rng.choice([-60, 60, 1000])
        row = {"e": "trade", "E": i, "p": str(price), "q": rng.uniform(1, 25)}
        out.append("{broken" if i % 17 == 0 else json.dumps(row if i % 3 else {**row, "e": "markPriceUpdate", "r": row["q"]}))
    return out


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def stream(spark, folder):
    raw = read_landed(spark, str(folder), streaming=True, maxFilesPerTrigger=1)
    points = decode_feed(raw, "binance", as_of_ms=NOW)
    # Order columns may not be null; broken messages have no time.
    points = points.withColumn("seq", F.coalesce("timestamp_ns", F.lit(0)))
    return gate_stream(points, OPTS, "feed", ["seq"], NOW)


def outputs(spark, base):
    good = sorted(r.value for r in spark.read.text(f"{base}/good/*").collect())
    bad = sorted(json.loads(r.value)["reason"] for r in spark.read.text(f"{base}/bad/*").collect())
    return good, bad


def go(spark, folder, base, **how):
    query = start(
        stream(spark, folder), f"{base}/good", f"{base}/bad", f"{base}/state", 2,
        OutputOptions(format="canonical_jsonl"), OPTS, NOW, **how,
    )
    return query


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path)
    land(folder, "1.txt", messages(1, 0, 60))
    assert run_for(go(spark, folder, base), None)
    # A new query on the same checkpoint goes on with the stored baselines.
    land(folder, "2.txt", messages(2, 60, 60))
    query = go(spark, folder, base)
    assert run_for(query, None)
    batch = decode_feed(read_landed(spark, str(folder)), "binance", as_of_ms=NOW)
    batch = batch.withColumn("seq", F.coalesce("timestamp_ns", F.lit(0)))
    want = gate_points(batch, OPTS, "feed", ["seq"], NOW)
    good, bad = outputs(spark, base)
    counts = {r.status: r["count"] for r in want.groupBy("status").count().collect()}
    assert (len(good), len(bad)) == (counts[P.ACCEPTED], counts[P.REJECTED])
    times = sorted(json.loads(g)["timestamp_ns"] for g in good)
    assert times == sorted(r.timestamp_ns for r in want.filter("status = 'accepted'").collect())
    assert sum("Sudden change" in b for b in bad) == want.filter("reason_code = 'SPIKE'").count() > 0
    seen = sum(p["observedMetrics"]["outcomes"]["accepted"] for p in map(json.loads, (x.json for x in query.recentProgress)) if p["observedMetrics"])
    assert seen > 0


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    """The sink of a micro-batch may run twice; the second run replaces the first."""
    folder, base = tmp_path / "in", str(tmp_path)
    land(folder, "1.txt", messages(1, 0, 30))
    again = []

    def repeat(batch, batch_id):
        if not again:
            again.append(batch_id)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run_for(go(spark, folder, base, on_batch=repeat), None)
    run_for(go(spark, folder, base), None)
    good, bad = outputs(spark, base)
    assert len(good) + len(bad) == 30


def test_time_limit_stops_a_stream(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path)
    land(folder, "1.txt", messages(1, 0, 5))
    query = go(spark, folder, base, every="1 second")
    assert run_for(query, 8) is False
    assert not query.isActive


def test_stateless_stream_needs_no_state(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1.txt", messages(1, 0, 20))
    raw = read_landed(spark, str(folder), streaming=True)
    checked = apply_checks(decode_feed(raw, "binance", as_of_ms=NOW), OPTS, NOW)
    query = checked.select("status").writeStream.format("memory").queryName("stateless").trigger(availableNow=True).start()
    run_for(query, None)
    assert spark.table("stateless").count() == 20


def start_versioned(spark, folder, base, stream_options=None, **how):
    raw = read_landed(spark, str(folder), streaming=True, maxFilesPerTrigger=1)
    points = decode_feed(raw, "binance", as_of_ms=NOW).withColumn("seq", F.coalesce("timestamp_ns", F.lit(0)))
    return start_gate(
        points, OPTS, "feed", ["seq"], f"{base}/good", f"{base}/bad", f"{base}/baselines", f"{base}/state", 2,
        OutputOptions(format="canonical_jsonl"), NOW, **how,
    )


@pytest.mark.parametrize("rows", [10**6, 7])
def test_versioned_baselines_equal_batch_over_restarts(spark, tmp_path, rows):
    folder, base = tmp_path / "in", str(tmp_path)
    for number, (seed, begin) in enumerate(((1, 0), (2, 60), (3, 120), (4, 180))):
        land(folder, f"{number}.txt", messages(seed, begin, 60))
        if number != 1:  # two files wait for the third start
            assert run_for(start_versioned(spark, folder, base, max_key_rows=rows), None)
    batch = decode_feed(read_landed(spark, str(folder)), "binance", as_of_ms=NOW)
    want = gate_points(batch.withColumn("seq", F.coalesce("timestamp_ns", F.lit(0))), OPTS, "feed", ["seq"], NOW)
    good, bad = outputs(spark, base)
    assert len(good) == want.filter("status = 'accepted'").count()
    assert len(bad) == want.filter("status = 'rejected'").count() and any("Sudden" in b for b in bad)
    assert versions(spark, f"{base}/baselines") == [1, 2, 3]


def test_batch_that_fails_after_its_outputs_gives_the_same_again(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path)
    land(folder, "1.txt", messages(1, 0, 80))
    assert run_for(start_versioned(spark, folder, base), None)
    land(folder, "2.txt", messages(2, 80, 80))

    def fail(judged, number):
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        run_for(start_versioned(spark, folder, base, on_batch=fail), None)
    assert run_for(start_versioned(spark, folder, base), None)
    batch = decode_feed(read_landed(spark, str(folder)), "binance", as_of_ms=NOW)
    want = gate_points(batch.withColumn("seq", F.coalesce("timestamp_ns", F.lit(0))), OPTS, "feed", ["seq"], NOW)
    good, bad = outputs(spark, base)
    assert (len(good), len(bad)) == tuple(want.filter(F.col("status") == x).count() for x in ("accepted", "rejected"))


def test_forgotten_keys(spark):
    before = spark.createDataFrame([("a", [1.0], 3), (None, [2.0], 5), ("b", [3.0], 4)], VERSION)
    after = spark.createDataFrame([("a", [9.0])], "key string, state array<double>")
    got = {(r.key, r.state[0], r.batch) for r in carried_on(before, after, 6, 1).collect()}
    assert got == {("a", 9.0, 6), (None, 2.0, 5)}
    assert carried_on(before, after, 6, None).count() == 3
