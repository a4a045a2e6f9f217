"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the number of local threads. Every
query runs in full into a no-op sink; the best of BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plantlake.operators.gold import hourly  # noqa: E402
from plantlake.plans import feeds  # noqa: E402
from plantlake.plans.catalog import QUERIES  # noqa: E402
from plantlake.plans.daily import bronze_to_silver, silver_to_gold  # noqa: E402
from plantlake.session import fresh_path, pin_utc  # noqa: E402
from plantlake.sources import files  # noqa: E402
from plantlake.streaming.landing_job import PARTITIONS, landing_rows  # noqa: E402

HEADLINE = [
    "event_decode",
    "silver_clean",
    "gold_hourly",
    "gold_daily",
    "top_critical",
    "alerts_batch",
    "alerts_stream",
    "range_anomaly",
    "dq_report",
    "dq_duplicate_rate",
    "maintenance_latest",
    "dash_trend",
    "factory_conflicts",
    "bronze_landing",
    "daily_chain",
]


def jobs(spark: SparkSession, sf_dir: str) -> dict:
    """The two daily jobs from disk to disk, and Gold alone over Parquet Silver."""
    pin_utc(spark)
    root = fresh_path(spark, "bench")
    lines = feeds.sensor_lines(feeds.table(spark, sf_dir, "events"))
    landing_rows(lines).write.partitionBy(*PARTITIONS).text(f"{root}/bronze")
    bronze = files.bronze_sensors(spark, f"{root}/bronze")
    bronze_to_silver(bronze, f"{root}/parquet", fmt="parquet")

    def to_silver():
        bronze_to_silver(bronze, f"{root}/silver")

    def to_gold():
        silver_to_gold(files.silver(spark, f"{root}/silver"), f"{root}/gold")

    def rollup():
        gold = hourly(files.silver(spark, f"{root}/parquet", "parquet"))
        gold.write.format("noop").mode("overwrite").save()

    return {"job_bronze_to_silver": to_silver, "job_silver_to_gold": to_gold, "gold_from_parquet": rollup}


def best_of(runs: int, action) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # no Python call sites in error messages: cheaper plan building
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        times[name] = best_of(
            runs,
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    for name, action in jobs(spark, sf_dir).items():
        times[name] = best_of(runs, action)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
