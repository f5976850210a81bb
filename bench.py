"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up, then the median of $BENCH_RUNS runs, each
forced end to end with a ``noop`` write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from arrivals.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "build_fact",
    "build_dimension_state",
    "build_dimension_country",
    "build_dimension_filtered",
    "publish_report",
    "arrivals_by_nation_month",
    "decode_role_playing",
    "decode_left",
    "star_by_state",
    "star_by_country",
    "quality_duplicate_keys",
    "null_profile",
]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("arrivals-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) if cpus.isdigit() else 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def run_once(spark: SparkSession, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up (JIT, file listing caches)
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
