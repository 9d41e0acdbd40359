"""Queries of the sinks and of stream runs: outputs are written and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pointgate.operators.gate import apply_checks
from pointgate.operators.normalize import normalize_columns
from pointgate.operators.points import with_point
from pointgate.options import GateOptions, OutputOptions, PointMapping, TimeSpec
from pointgate.plans.fixtures import AS_OF_MS, event_points, table, text
from pointgate.plans.gate_queries import (
    ALL_BOUND_RULES,
    FULL,
    GATED_SQL,
    ORDER,
    P_SQL,
    TIME_RULES,
    WIDE,
    options,
    shown,
    spikes_only_sql,
    verdict_sql,
)
from pointgate.plans.registry import register
from pointgate.plans.run import gate_points, run_batch, run_committed
from pointgate.session import scratch_path
from pointgate.sinks import render
from pointgate.sinks.commit import Outputs, committed_runs, read_accepted, read_dead_letter
from pointgate.sinks.write import quarantine_unwritable, write_accepted, write_both
from pointgate.streaming.baselines import start_gate
from pointgate.streaming.run import gate_stream, run_for, start
from pointgate.streaming.spikes import stream_spikes

# ---- dead letter -----------------------------------------------------------------------------------------


def _rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents are no JSON points: all are rejected with their whole text as raw record."""
    documents = table(spark, sf_dir, "documents")
    points = with_point(
        documents,
        F.lit(None).cast("bigint"),
        F.lit(None).cast("array<double>"),
        F.col("text"),
        parse_error=F.lit("invalid JSON"),
    )
    return apply_checks(points, options(), AS_OF_MS)


_DEAD_HEAD = f"doc_id, {AS_OF_MS * 1_000_000} AS timestamp_ns, 'Parse Error: invalid JSON' AS reason"


def _dead_letter(spark: SparkSession, sf_dir: str, opts: OutputOptions) -> DataFrame:
    judged = _rejected_documents(spark, sf_dir)
    return judged.select(
        "doc_id",
        F.coalesce("timestamp_ns", F.lit(AS_OF_MS * 1_000_000)).alias("timestamp_ns"),
        render.reason_text().alias("reason"),
        render.shaped_raw(opts).alias("raw_record"),
    )


@register("deadletter_plain", f"SELECT {_DEAD_HEAD}, text AS raw_record FROM documents")
def deadletter_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dead_letter(spark, sf_dir, OutputOptions())


@register("deadletter_hash", f"SELECT {_DEAD_HEAD}, sha256(text) AS raw_record FROM documents")
def deadletter_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashing wins over truncation."""
    return _dead_letter(spark, sf_dir, OutputOptions(hash_raw=True, truncate_raw=True))


@register(
    "deadletter_truncate",
    f"""
WITH cut AS (
  SELECT doc_id, text, strlen(text) > 512 AS long, regexp_extract(text, '(?s)^.{{0,512}}') AS head FROM documents),
chars AS (
  SELECT doc_id, text, long, list_transform(range(0, 513), lambda n: head[1:n]) AS heads FROM cut),
fits AS (
  SELECT doc_id, text, long, list_filter(heads, lambda h: strlen(h) <= 512)[-1] AS fit FROM chars)
SELECT {_DEAD_HEAD},
       CASE WHEN NOT long THEN text
            ELSE fit || CASE WHEN strlen(fit) < 512 THEN '�' ELSE '' END || ' (truncated)' END AS raw_record
FROM fits
""",
)
def deadletter_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutting is the feature: raw records keep 512 bytes, a character cut in two is replaced."""
    return _dead_letter(spark, sf_dir, OutputOptions(truncate_raw=True))


# Reason texts, as in ``sinks.render``.
_REASON_SQL = """CASE reason_code
    WHEN 'BELOW_MIN' THEN printf('Value below minimum: metric_%d=%.2f < min=%.2f',
                                 CAST(metric_idx AS INTEGER), observed, limit_value)
    WHEN 'ABOVE_MAX' THEN printf('Value exceeds maximum: metric_%d=%.2f > max=%.2f',
                                 CAST(metric_idx AS INTEGER), observed, limit_value)
    WHEN 'TOO_FUTURE' THEN 'Timestamp too far in future: ' || CAST(observed AS BIGINT) || 'ms ahead of tolerance'
    WHEN 'TOO_OLD' THEN 'Timestamp too old: ' || CAST(observed AS BIGINT) || 'ms exceeds staleness limit of '
                        || CAST(limit_value AS BIGINT) || 'ms'
    ELSE printf('Sudden change detected: metric_0 delta=%.2f exceeds threshold %.2f (baseline=%.2f)',
                observed, limit_value, baseline) END"""


@register(
    "deadletter_lines",
    GATED_SQL
    + f"""
SELECT timestamp_ns, {_REASON_SQL} AS reason,
  '{{"k": ' || CAST(CAST(metric_1 AS BIGINT) AS VARCHAR) || '}}' AS raw_record
FROM gated WHERE status = 'rejected'
""",
)
def deadletter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the dead letter, parsed again: whole reason texts with their two-decimal numbers."""
    gated = gate_points(event_points(spark, sf_dir), options(**FULL), "event_type", ORDER, AS_OF_MS, 2)
    path = scratch_path(spark, "dead")
    render.dead_letter_lines(gated, OutputOptions(), options(**FULL), AS_OF_MS).write.text(path)
    back = spark.read.text(path).select(
        F.from_json("value", "timestamp_ns bigint, reason string, raw_record string").alias("r")
    )
    return back.select("r.timestamp_ns", "r.reason", "r.raw_record")


# ---- accepted outputs ------------------------------------------------------------------------------------

_V_SQL = f"WITH {P_SQL}, v AS ({verdict_sql(ALL_BOUND_RULES + TIME_RULES)})"


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = options(**{**FULL, "spike_max_delta": {}})
    return apply_checks(event_points(spark, sf_dir), opts, AS_OF_MS, 2)


@register(
    "canonical_jsonl",
    """
SELECT '{"timestamp_ns":' || (epoch_us(l_shipdate) * 1000) || ',"feed":"' || l_returnflag || '","metric_0":'
       || CAST(l_quantity AS VARCHAR) || ',"metric_1":' || CAST(l_extendedprice AS VARCHAR) || ',"metric_2":'
       || l_linenumber || 'e20}' AS value
FROM lineitem
""",
)
def canonical_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines byte for byte; metric 2 is so big that it is printed with an exponent."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "big", text(F.col("l_linenumber"), "e20").cast("double")
    )
    mapping = PointMapping({"l_quantity": 0, "l_extendedprice": 1, "big": 2}, 3, TimeSpec(field="l_shipdate"))
    points = normalize_columns(lines, mapping, F.lit("")).withColumn("feed", F.col("l_returnflag"))
    return points.select(render.canonical_line(3, OutputOptions(format="canonical_jsonl")).alias("value"))


@register(
    "jsonl_sink",
    f"{_V_SQL} SELECT timestamp_ns, event_type AS feed, m0 AS metric_0, m1 AS metric_1 FROM v WHERE status = 'accepted'",
)
def jsonl_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl-out")
    write_accepted(_checked(spark, sf_dir), path, 2, OutputOptions(format="jsonl"))
    fields = "timestamp_ns bigint, feed string, metric_0 double, metric_1 double"
    return spark.read.schema(fields).json(path)


@register(
    "csv_sink",
    f"""{_V_SQL}
SELECT CAST(timestamp_ns AS VARCHAR) AS timestamp_ns, regexp_replace(CAST(m0 AS VARCHAR), '\\.0$', '') AS price,
       CAST(CAST(m1 AS BIGINT) AS VARCHAR) AS volume
FROM v WHERE status = 'accepted'""",
)
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-out")
    write_accepted(_checked(spark, sf_dir), path, 2, OutputOptions(format="csv"))
    return spark.read.option("header", True).csv(path)


@register(
    "parquet_sink",
    f"""{_V_SQL}
SELECT 'accepted' AS output, timestamp_ns, event_type AS feed, m0 AS price, m1 AS volume, CAST(NULL AS VARCHAR) AS reason_code
FROM v WHERE status = 'accepted'
UNION ALL
SELECT 'dead letter', timestamp_ns, NULL, NULL, NULL, reason_code FROM v WHERE status = 'rejected'""",
)
def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of one pass."""
    good, bad = scratch_path(spark, "accepted"), scratch_path(spark, "dead")
    write_both(_checked(spark, sf_dir), good, bad, 2, OutputOptions(), as_of_ms=AS_OF_MS, dead_letter_text=False)
    accepted = spark.read.parquet(good).select(
        F.lit("accepted").alias("output"), "timestamp_ns", "feed", "price", "volume",
        F.lit(None).cast("string").alias("reason_code"),
    )
    none = F.lit(None)
    dead = spark.read.parquet(bad).select(
        F.lit("dead letter").alias("output"),
        "timestamp_ns",
        none.cast("string").alias("feed"),
        none.cast("double").alias("price"),
        none.cast("double").alias("volume"),
        "reason_code",
    )
    return accepted.unionByName(dead)


@register(
    "run_counters",
    GATED_SQL
    + """
SELECT count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS dropped,
       count(*) FILTER (status = 'accepted') AS written, count(*) FILTER (status = 'rejected') AS dead
FROM gated
""",
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole batch run: counters observed while writing, and the rows found in both outputs."""
    good, bad = scratch_path(spark, "accepted"), scratch_path(spark, "dead")
    opts = options(**FULL)
    counters = run_batch(
        event_points(spark, sf_dir), opts, OutputOptions(format="canonical_jsonl"), good, bad, 2,
        "event_type", ORDER, AS_OF_MS,
    )
    written = spark.read.text(good).agg(F.count("*").alias("written"))
    dead = spark.read.text(bad).agg(F.count("*")).scalar()
    return written.select(
        F.lit(counters["accepted"]).cast("bigint").alias("accepted"),
        F.lit(counters["dropped"]).cast("bigint").alias("dropped"),
        "written",
        dead.alias("dead"),
    )


@register(
    "two_output_commit",
    GATED_SQL
    + """
SELECT 'whole' AS run, 'accepted' AS output, timestamp_ns, metric_0 AS price, 2 AS runs FROM gated WHERE status = 'accepted'
UNION ALL
SELECT 'whole', 'dead letter', timestamp_ns, NULL, 2 FROM gated WHERE status = 'rejected'
UNION ALL
SELECT 'unchecked', 'accepted', timestamp_ns, metric_0, 2 FROM gated
""",
)
def two_output_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs are visible with their manifest row alone: one repeated after a failure between its outputs, one that
    never got that far, and one more under other options."""
    outputs, form = Outputs(scratch_path(spark, "outputs")), OutputOptions()
    points, opts = event_points(spark, sf_dir), options(**FULL)
    for failed in ("whole", "lost"):
        judged = gate_points(points, opts, None, ORDER, AS_OF_MS, 2)
        write_accepted(judged, f"{outputs.accepted}/run={failed}", 2, form, AS_OF_MS)
    how = {"as_of_ms": AS_OF_MS, "order": ORDER, "dead_letter_text": False}
    run_committed(points, opts, form, outputs, "whole", 2, key="event_type", **how)
    loose = options(replay_mode=True, reject_nan_inf=False)
    run_committed(points, loose, form, outputs, "unchecked", 2, **how)
    runs = F.lit(committed_runs(spark, outputs).count()).alias("runs")
    good = read_accepted(spark, outputs, form).select("run", F.lit("accepted").alias("output"), "timestamp_ns", "price", runs)
    dead = read_dead_letter(spark, outputs, form, as_text=False).select(
        "run", F.lit("dead letter").alias("output"), "timestamp_ns", F.lit(None).cast("double").alias("price"), runs
    )
    return good.unionByName(dead)


_ROUTES = {"click": "clicks", "view": "views", "error": "errors"}
_ROUTE_SQL = "CASE event_type " + " ".join(f"WHEN '{f}' THEN '{r}'" for f, r in _ROUTES.items()) + " END"


@register(
    "route_by_feed",
    f"""{_V_SQL}, r AS (SELECT *, {_ROUTE_SQL} AS route FROM v)
SELECT route, timestamp_ns, m0 AS price, m1 AS volume, CAST(NULL AS VARCHAR) AS reason_code
FROM r WHERE status = 'accepted' AND route IS NOT NULL
UNION ALL
SELECT 'dead letter', timestamp_ns, NULL, NULL, coalesce(reason_code, 'UNKNOWN_FEED')
FROM r WHERE status = 'rejected' OR route IS NULL""",
)
def route_by_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per feed, without the feed column; points of other feeds go to the dead letter."""
    opts = OutputOptions(prefix_by_feed=_ROUTES, channel_scoped=True)
    routed = quarantine_unwritable(_checked(spark, sf_dir), opts)
    path = scratch_path(spark, "routes")
    write_accepted(routed, path, 2, opts, AS_OF_MS)
    accepted = spark.read.parquet(path).select(
        "route", "timestamp_ns", "price", "volume", F.lit(None).cast("string").alias("reason_code")
    )
    dead = render.dead_letter_rows(routed, opts, as_of_ms=AS_OF_MS).select(
        F.lit("dead letter").alias("route"),
        "timestamp_ns",
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("volume"),
        "reason_code",
    )
    return accepted.unionByName(dead)


@register(
    "daily_partition",
    f"""{_V_SQL}
SELECT 'by event' AS split, strftime(make_timestamp(timestamp_ns // 1000), '%Y-%m-%d') AS day, count(*) AS n,
       sum(CAST(m1 AS BIGINT))::BIGINT AS k
FROM v WHERE status = 'accepted' GROUP BY 2
UNION ALL
SELECT 'by run', '2024-01-20', count(*), sum(CAST(m1 AS BIGINT))::BIGINT FROM v WHERE status = 'accepted'""",
)
def daily_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = OutputOptions(daily=True)
    parts = []
    for split, by_event in (("by event", True), ("by run", False)):
        path = scratch_path(spark, "days")
        write_accepted(_checked(spark, sf_dir), path, 2, opts, AS_OF_MS, by_event_day=by_event)
        back = spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"))
        counted = back.agg(F.count("*").alias("n"), F.sum("volume").cast("bigint").alias("k"))
        parts.append(counted.select(F.lit(split).alias("split"), "day", "n", "k"))
    return parts[0].unionByName(parts[1])


# ---- streams ---------------------------------------------------------------------------------------------


def _run_by_slices(
    spark: SparkSession, sf_dir: str, slices: int, begin: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Land event points slice by slice in time order; after each, ``begin`` starts the stream anew on the folder.

    The query takes what is new and ends; its checkpoint carries files done and baselines to the next start.
    """
    points = event_points(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "timestamp_ns", "metrics", "feed", "raw", "parse_error", "error_code"
    )
    root = scratch_path(spark, "stream-in")
    # Slices of the whole span of time; together they hold every row.
    span = points.agg(F.min("timestamp_ns").alias("lo"), F.max("timestamp_ns").alias("hi")).first()
    step = (span.hi - span.lo) // slices + 1
    for i in range(slices):
        low = span.lo + i * step
        part = points.filter((F.col("timestamp_ns") >= low) & (F.col("timestamp_ns") < low + step))
        part.write.mode("append").parquet(root)
        run_for(begin(spark.readStream.schema(points.schema).parquet(root)), None)


@register("stream_spike_equals_batch", spikes_only_sql("event_type"))
def stream_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed state carries over micro-batches and restarts: same result as the batch check."""
    opts = options(spike_max_delta={0: 100.0}, **WIDE)
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")

    def begin(stream: DataFrame) -> StreamingQuery:
        gated = stream_spikes(apply_checks(stream, opts, AS_OF_MS, 2), opts, "event_type", ORDER)
        writer = shown(gated, "baseline").writeStream.format("parquet").option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start(out)

    _run_by_slices(spark, sf_dir, 3, begin)
    return spark.read.parquet(out)


_OUTPUTS = ("SELECT 'accepted' AS output, timestamp_ns, event_type AS feed, metric_0, metric_1 FROM {} "
            "WHERE status = 'accepted' UNION ALL "
            "SELECT 'dead letter', timestamp_ns, NULL, NULL, NULL FROM {} WHERE status = 'rejected'")  # fmt: skip


def _read_stream_outputs(spark: SparkSession, good: str, bad: str) -> DataFrame:
    accepted = spark.read.schema("timestamp_ns bigint, feed string, metric_0 double, metric_1 double").json(
        f"{good}/*"
    )
    dead = spark.read.schema("timestamp_ns bigint").json(f"{bad}/*")
    none = F.lit(None)
    return accepted.select(F.lit("accepted").alias("output"), "timestamp_ns", "feed", "metric_0", "metric_1").unionByName(
        dead.select(
            F.lit("dead letter").alias("output"),
            "timestamp_ns",
            none.cast("string").alias("feed"),
            none.cast("double").alias("metric_0"),
            none.cast("double").alias("metric_1"),
        )
    )


def _stream_outputs(spark: SparkSession, sf_dir: str, opts: GateOptions, key: str | None, slices: int) -> DataFrame:
    """Both outputs of a stream that is started once per slice, read back."""
    good, bad, state = (scratch_path(spark, label) for label in ("accepted", "dead", "stream-state"))

    def begin(stream: DataFrame) -> StreamingQuery:
        gated = gate_stream(stream, opts, key, ORDER, AS_OF_MS, 2)
        return start(gated, good, bad, state, 2, OutputOptions(format="jsonl"), opts, AS_OF_MS)

    _run_by_slices(spark, sf_dir, slices, begin)
    return _read_stream_outputs(spark, good, bad)


@register("stream_gate_equals_batch", GATED_SQL + _OUTPUTS.format("gated", "gated"))
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate on a stream: baselines in a versioned table, a hot key split over tasks, both outputs per micro-batch."""
    good, bad, state, table_ = (scratch_path(spark, n) for n in ("accepted", "dead", "stream-state", "baselines"))
    opts = options(**FULL)

    def begin(stream: DataFrame) -> StreamingQuery:
        return start_gate(
            stream, opts, "event_type", ORDER, good, bad, table_, state, 2, OutputOptions(format="jsonl"), AS_OF_MS,
            max_key_rows=500,
        )

    _run_by_slices(spark, sf_dir, 2, begin)
    return _read_stream_outputs(spark, good, bad)


@register("limit_max_duration", f"{_V_SQL}, r AS (SELECT *, m0 AS metric_0, m1 AS metric_1 FROM v) " + _OUTPUTS.format("r", "r"))
def limit_max_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that its time limit ends, and the run that goes on after it: no record twice, none lost."""
    good, bad, state, root = (scratch_path(spark, n) for n in ("accepted", "dead", "stream-state", "stream-in"))
    opts = options(**{**FULL, "spike_max_delta": {}})
    points = event_points(spark, sf_dir).select(
        "event_id", "timestamp_ns", "metrics", "feed", "raw", "parse_error", "error_code"
    )
    points.repartition(4, "event_id").write.parquet(root)

    def begin(every: str | None) -> StreamingQuery:
        stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(root)
        gated = gate_stream(stream, opts, None, ORDER, AS_OF_MS, 2)
        return start(gated, good, bad, state, 2, OutputOptions(format="jsonl"), opts, AS_OF_MS, every)

    # a processing-time run never ends by itself
    if run_for(begin("2 seconds"), 4):
        raise RuntimeError("the time limit did not end the run")
    run_for(begin(None), None)
    return _read_stream_outputs(spark, good, bad)


@register("stream_restart", f"{_V_SQL}, r AS (SELECT *, m0 AS metric_0, m1 AS metric_1 FROM v) " + _OUTPUTS.format("r", "r"))
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateless checks on a stream that is stopped and started again as files arrive: no record twice, none lost."""
    return _stream_outputs(spark, sf_dir, options(**{**FULL, "spike_max_delta": {}}), None, 3)


@register(
    "header_check",
    """
SELECT l_quantity AS qty, l_extendedprice AS amount, epoch_us(l_shipdate) * 1000 AS timestamp_ns, true AS refused
FROM lineitem, range(2)
""",
)
def header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending under other headers is refused before anything is written; under the same ones it is done."""
    lines = table(spark, sf_dir, "lineitem")
    mapping = PointMapping({"l_quantity": 0, "l_extendedprice": 1}, 2, TimeSpec(field="l_shipdate"))
    checked = apply_checks(normalize_columns(lines, mapping, F.lit(""), AS_OF_MS), options(replay_mode=True), AS_OF_MS, 2)
    path = scratch_path(spark, "headers")
    refused = False
    for headers in (("qty", "amount"), ("amount", "qty"), ("qty", "amount")):
        try:
            write_accepted(checked, path, 2, OutputOptions(format="csv", headers=headers), AS_OF_MS)
        except ValueError:
            refused = headers == ("amount", "qty")
    back = spark.read.option("header", True).csv(path)
    return back.select(
        F.col("qty").cast("double").alias("qty"),
        F.col("amount").cast("double").alias("amount"),
        F.col("timestamp_ns").cast("bigint").alias("timestamp_ns"),
        F.lit(refused).alias("refused"),
    )
