"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables, BENCH_CPUS: local cores, BENCH_RUNS: timed runs per query after
one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from clickmart.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "transform_stg",
    "mart_funnel_daily",
    "mart_session",
    "mart_cohort",
    "mart_item_stats",
    "dq_checks",
    "build_events",
    "assign_users",
    "enrich_profile",
    "encode_messages",
    "user_profile_stats",
    "limit_events",
    "scan_raw_jsonl",
    "stg_roundtrip",
    "incremental_day",
    "stream_raw_landing",
    "stream_clean",
    "stream_funnel",
    "daily_run_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
    )
    spark = builder.config(
        "spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickmart-bench-")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 4)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()

    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
