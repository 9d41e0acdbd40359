"""Queries of the gate, its limits and counters, over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointgate.operators.counts import outcome_counts
from pointgate.operators.gate import apply_checks
from pointgate.operators.points import metric_columns
from pointgate.operators.spike import apply_spikes
from pointgate.operators.limits import limit_accepted
from pointgate.options import Bound, GateOptions, LimitOptions
from pointgate.plans.fixtures import AS_OF_MS, DAY_MS, event_points
from pointgate.plans.registry import register
from pointgate.plans.run import gate_points

ORDER = ("timestamp_ns", "event_id")
BOUNDS = {0: Bound(1.0, 400.0), 1: Bound(5.0, 95.0)}

# Points of events, as SQL.
P_SQL = """
p AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) * 1000 AS timestamp_ns, value AS m0,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS m1
  FROM events)
"""
NOW_MS = str(AS_OF_MS)
FUTURE = f"(timestamp_ns // 1000000) > {NOW_MS} + {DAY_MS}"
STALE = f"{NOW_MS} - (timestamp_ns // 1000000) > {10 * DAY_MS}"


def options(**changes) -> GateOptions:
    return GateOptions(**{"future_tolerance_ms": DAY_MS, "stale_tolerance_ms": 10 * DAY_MS, **changes})


def shown(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "event_id",
        "timestamp_ns",
        *metric_columns(["metric_0", "metric_1"]),
        "status",
        "reason_code",
        # Whole numbers with nulls change type in pandas; results are compared there.
        F.col("metric_idx").cast("double").alias("metric_idx"),
        "observed",
        "limit_value",
        *more,
    )


def verdict_sql(rules: list[tuple[str, str, str, str, str]], source: str = "p") -> str:
    """rules: (condition, code, metric, observed, limit), first match wins."""

    def case(slot: int, kind: str, fallback: str = "NULL") -> str:
        whens = " ".join(f"WHEN {r[0]} THEN {r[slot]}" for r in rules)
        return f"CAST(CASE {whens} ELSE {fallback} END AS {kind})"

    quoted = [(r[0], f"'{r[1]}'", *r[2:]) for r in rules]
    rules = quoted
    return f"""
  SELECT *, CASE WHEN {" OR ".join(f"({r[0]})" for r in rules)} THEN 'rejected' ELSE 'accepted' END AS status,
         {case(1, "VARCHAR")} AS reason_code, {case(2, "DOUBLE")} AS metric_idx,
         {case(3, "DOUBLE")} AS observed, {case(4, "DOUBLE")} AS limit_value
  FROM {source}"""


def bound_rules(index: int, low: float | None, high: float | None) -> list[tuple[str, str, str, str, str]]:
    rules = []
    if low is not None:
        rules.append((f"m{index} < {low}", "BELOW_MIN", str(index), f"m{index}", str(low)))
    if high is not None:
        rules.append((f"m{index} > {high}", "ABOVE_MAX", str(index), f"m{index}", str(high)))
    return rules


TIME_RULES = [
    (FUTURE, "TOO_FUTURE", "NULL", f"(timestamp_ns // 1000000) - {AS_OF_MS + DAY_MS}", str(DAY_MS)),
    (STALE, "TOO_OLD", "NULL", f"{NOW_MS} - (timestamp_ns // 1000000)", str(10 * DAY_MS)),
]
ALL_BOUND_RULES = bound_rules(0, 1.0, 400.0) + bound_rules(1, 5.0, 95.0)
COLUMNS_SQL = (
    "event_id, timestamp_ns, m0 AS metric_0, m1 AS metric_1, status, reason_code, metric_idx, observed, limit_value"
)


def judged_sql(rules, extra: str = "") -> str:
    return f"WITH {P_SQL}, v AS ({verdict_sql(rules)}) SELECT {COLUMNS_SQL}{extra} FROM v"


@register("gate_bounds", judged_sql(ALL_BOUND_RULES))
def gate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = options(bounds=BOUNDS, replay_mode=True)
    return shown(apply_checks(event_points(spark, sf_dir), opts, AS_OF_MS, width=2))


@register(
    "gate_bounds_default",
    judged_sql(bound_rules(0, None, 300.0) + bound_rules(1, 0.0, None)).replace(
        "json_extract_string(props, '$.k') AS DOUBLE)", "json_extract_string(props, '$.k') AS DOUBLE) - 50"
    ),
)
def gate_bounds_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No bounds section: metric 0 by the price setting, metric 1 never negative."""
    points = event_points(spark, sf_dir)
    shifted = points.withColumn(
        "metrics", F.array(F.get("metrics", F.lit(0)), F.get("metrics", F.lit(1)) - F.lit(50.0))
    )
    return shown(apply_checks(shifted, options(price_max=300.0, replay_mode=True), AS_OF_MS, width=2))



@register(
    "gate_nonfinite",
    f"""
WITH {P_SQL}, q AS (SELECT *, event_id % 97 < 3 AS bad FROM p)
SELECT event_id, timestamp_ns, m1 AS metric_1, CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN bad THEN 'NON_FINITE' END AS reason_code
FROM q
""",
)
def gate_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    kind = F.pmod("event_id", F.lit(97))
    special = F.when(kind == 0, float("inf")).when(kind == 1, float("-inf")).when(kind == 2, float("nan"))
    points = points.withColumn(
        "metrics", F.array(F.coalesce(special, F.get("metrics", F.lit(0))), F.get("metrics", F.lit(1)))
    )
    judged = apply_checks(points, options(replay_mode=True), AS_OF_MS, width=2)
    return shown(judged).select("event_id", "timestamp_ns", "metric_1", "status", "reason_code")


@register("gate_time", judged_sql(TIME_RULES))
def gate_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(apply_checks(event_points(spark, sf_dir), options(), AS_OF_MS, width=2))


@register("gate_replay", judged_sql(ALL_BOUND_RULES))
def gate_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay skips the time checks and the spike check."""
    opts = options(bounds=BOUNDS, replay_mode=True, spike_max_delta={0: 100.0})
    return shown(gate_points(event_points(spark, sf_dir), opts, "event_type", ORDER, AS_OF_MS, 2))


@register(
    "gate_no_fail_fast",
    judged_sql(
        TIME_RULES,
        ", (CASE WHEN m0 < 1.0 THEN 1 ELSE 0 END + CASE WHEN m0 > 400.0 THEN 1 ELSE 0 END"
        " + CASE WHEN m1 < 5.0 THEN 1 ELSE 0 END + CASE WHEN m1 > 95.0 THEN 1 ELSE 0 END)::INTEGER AS n_violations",
    ),
)
def gate_no_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations are listed but the record is accepted; time checks still reject."""
    opts = options(bounds=BOUNDS, fail_fast=False, spike_max_delta={0: 100.0})
    gated = gate_points(event_points(spark, sf_dir), opts, "event_type", ORDER, AS_OF_MS, 2)
    return shown(gated.withColumn("n_violations", F.size("violations")), "n_violations")


def spike_sql(key: str, limit: float, source: str) -> str:
    """CTEs ``seq`` and ``walk``: the sequential baseline over rows of ``source`` per key."""
    return f"""
seq AS MATERIALIZED (
  SELECT event_id, {key} AS k, m0, row_number() OVER (PARTITION BY {key} ORDER BY timestamp_ns, event_id) AS rn
  FROM {source}),
walk AS (
  SELECT event_id, k, rn, m0 AS base, NULL::DOUBLE AS delta, NULL::DOUBLE AS against FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.event_id, s.k, s.rn,
         CASE WHEN w.base > 0 AND abs(s.m0 - w.base) > {limit} THEN w.base
              ELSE 0.05::DOUBLE * s.m0 + (1.0::DOUBLE - 0.05::DOUBLE) * w.base END,
         CASE WHEN w.base > 0 AND abs(s.m0 - w.base) > {limit} THEN abs(s.m0 - w.base) END,
         CASE WHEN w.base > 0 AND abs(s.m0 - w.base) > {limit} THEN w.base END
  FROM walk w JOIN seq s ON s.k = w.k AND s.rn = w.rn + 1)"""


def spikes_only_sql(key: str) -> str:
    return f"""
WITH RECURSIVE {P_SQL}, {spike_sql(key, 100.0, "p")}
SELECT p.event_id, timestamp_ns, m0 AS metric_0, m1 AS metric_1,
       CASE WHEN delta IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN delta IS NOT NULL THEN 'SPIKE' END AS reason_code,
       CASE WHEN delta IS NOT NULL THEN 0.0::DOUBLE END AS metric_idx,
       delta AS observed, CASE WHEN delta IS NOT NULL THEN 100.0::DOUBLE END AS limit_value, against AS baseline
FROM p JOIN walk USING (event_id)
"""


# Tolerances wide enough that only the spike check can reject.
WIDE = {"future_tolerance_ms": 400 * DAY_MS, "stale_tolerance_ms": 400 * DAY_MS}


def _spikes(spark: SparkSession, sf_dir: str, key: str, **how) -> DataFrame:
    opts = options(spike_max_delta={0: 100.0}, **WIDE)
    checked = apply_checks(event_points(spark, sf_dir), opts, AS_OF_MS, 2)
    return shown(apply_spikes(checked, opts, key, ORDER, **how), "baseline")


@register("gate_spike", spikes_only_sql("event_type"))
def gate_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spikes(spark, sf_dir, "event_type")


@register("gate_spike_split", spikes_only_sql("event_type"))
def gate_spike_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for big keys, forced: every event type is spread over several partitions."""
    return _spikes(spark, sf_dir, "event_type", max_key_rows=1_000)


@register("gate_spike_keyed", spikes_only_sql("user_id"))
def gate_spike_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spikes(spark, sf_dir, "user_id")


FULL = {"bounds": BOUNDS, "spike_max_delta": {0: 150.0}}
GATED_SQL = f"""
WITH RECURSIVE {P_SQL},
v AS ({verdict_sql(ALL_BOUND_RULES + TIME_RULES)}),
{spike_sql("event_type", 150.0, "v WHERE status = 'accepted'")},
gated AS (
  SELECT v.event_id, v.event_type, v.user_id, timestamp_ns, m0 AS metric_0, m1 AS metric_1,
         CASE WHEN delta IS NULL THEN status ELSE 'rejected' END AS status,
         CASE WHEN delta IS NULL THEN reason_code ELSE 'SPIKE' END AS reason_code,
         CASE WHEN delta IS NULL THEN metric_idx ELSE 0.0::DOUBLE END AS metric_idx,
         coalesce(delta, observed) AS observed,
         CASE WHEN delta IS NULL THEN limit_value ELSE 150.0::DOUBLE END AS limit_value, against AS baseline
  FROM v LEFT JOIN walk ON walk.event_id = v.event_id)
"""


def gated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_points(event_points(spark, sf_dir), options(**FULL), "event_type", ORDER, AS_OF_MS, 2)


@register(
    "quality_gate",
    GATED_SQL
    + "SELECT event_id, timestamp_ns, metric_0, metric_1, status, reason_code, metric_idx, observed, limit_value,"
    + " baseline FROM gated",
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain."""
    return shown(gated_events(spark, sf_dir), "baseline")


@register(
    "outcome_counts",
    GATED_SQL
    + """SELECT event_type, CAST(count(*) FILTER (status = 'accepted') AS BIGINT) AS accepted,
       CAST(count(*) FILTER (status = 'rejected') AS BIGINT) AS dropped
FROM gated GROUP BY event_type""",
)
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(gated_events(spark, sf_dir), ["event_type"])


@register(
    "limit_max_records",
    f"""
WITH {P_SQL}, v AS ({verdict_sql(ALL_BOUND_RULES)}),
n AS (SELECT *, count(*) FILTER (status = 'accepted')
          OVER (ORDER BY timestamp_ns, event_id ROWS UNBOUNDED PRECEDING) AS taken FROM v)
SELECT {COLUMNS_SQL} FROM n
WHERE taken < 500 OR (taken = 500 AND status = 'accepted')
""",
)
def limit_max_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature: the run ends with its 500th accepted record."""
    opts = options(bounds=BOUNDS, replay_mode=True)
    limits = LimitOptions(max_records=500)
    return shown(gate_points(event_points(spark, sf_dir), opts, None, ORDER, AS_OF_MS, 2, limits))


@register(
    "limit_max_records_big",
    f"""
WITH {P_SQL}, v AS ({verdict_sql(ALL_BOUND_RULES)}),
n AS (SELECT *, count(*) FILTER (status = 'accepted')
          OVER (ORDER BY timestamp_ns, event_id ROWS UNBOUNDED PRECEDING) AS taken FROM v)
SELECT {COLUMNS_SQL} FROM n
WHERE taken < 700 OR (taken = 700 AND status = 'accepted')
""",
)
def limit_max_records_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same limit with several ranges."""
    judged = apply_checks(event_points(spark, sf_dir), options(bounds=BOUNDS, replay_mode=True), AS_OF_MS, 2)
    return shown(limit_accepted(judged, 700, ORDER, part_rows=2_000, top_rows=0))
