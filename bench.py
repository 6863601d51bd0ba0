"""Wall time of the headline queries, as one JSON line.

Every query runs once to warm up and then RUNS times; all columns are computed and sent to a
sink that drops them. The value is the sum of the medians.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from saleslake.checks.queries import QUERIES
from saleslake.session import builder

HEADLINE = [
    "bronze_build",
    "silver_build",
    "gold_build",
    "agg_product_month",
    "top_product",
    "dedup_first",
    "join_rates",
    "trend_weekly_chain",
    "trend_monthly_chain",
    "trend_monthly_partition",
    "load_audit",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("saleslake-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
