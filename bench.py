"""Time the headline queries and print one JSON line.

Each query is run in full into Spark's no-op sink: no row is skipped and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from pointgate.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "gate_bounds",
    "gate_time",
    "gate_spike",
    "gate_spike_split",
    "gate_spike_keyed",
    "quality_gate",
    "outcome_counts",
    "parquet_mapped",
    "parquet_passthrough",
    "csv_scan",
    "jsonl_scan",
    "json_wrapped_scan",
    "normalize_json_paths",
    "kafka_decode",
    "feed_kraken",
    "feed_binance",
    "feed_eth",
    "cdc_change_rows",
    "syslog_5424",
    "rest_pages_decode",
    "limit_max_records",
    "canonical_jsonl",
    "csv_number_text",
    "deadletter_hash",
    "route_by_feed",
    "stream_gate_equals_batch",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pointgate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM's code paths and of the Python workers is not part of any query.
    QUERIES["gate_spike_keyed"](spark, sf_dir).limit(1).collect()
    seconds: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
