"""Headline queries at one scale; prints one JSON line.

Each query runs once cold, then three times; the median of the three counts. The
result is written to a sink that keeps nothing, so no row reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from fuelscope.workload import QUERIES

HEADLINE = [
    "i12_crack_spread",
    "f1_latest_set",
    "e16_previous_rows",
    "d4_as_of_7_days",
    "e10_percentiles",
    "f9_robust_smooth",
    "i1_daily_panel_events",
    "e14_gram",
    "i5_forecast",
    "i15_replay_by_source",
    "c3_selector_priority",
    "a5_insert_if_absent",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Small tables: let shuffled partitions stay as many as the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(warm)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
