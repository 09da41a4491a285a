"""Time the headline queries: one warm-up, then the median of three runs into the noop sink.

Prints one JSON line. Settings: BENCH_SF_DIR (default the sf0.1 tables) and BENCH_CPUS (default 8).
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark import prepare  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

RUNS = 3

# Pure queries: each run evaluates the whole plan, from the given tables or the published ones.
QUERY_RUNS = (
    "landing_build",
    "envelope_unwrap",
    "flatten_records",
    "fold_last_write",
    "landing_upsert",
    "incremental_scan",
    "page_deep",
    "paged_dump",
    "changed_rows",
    "flat_sync",
    "refresh_range",
    "json_contains",
    "json_contains_landing",
    "slice_state_incident",
    "slice_date_state",
    "money_range",
    "project_lookup",
    "money_topk",
    "project_join",
    "applicant_join",
    "rollup_state_incident",
    "rollup_month_state",
    "topk_disasters",
    "state_obligated",
)

# Whole load cycles, which write and publish tables: timed once after the queries above.
CYCLE_RUNS = ("replace_load", "cycle_update", "cycle_replay")


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    seconds = {}
    for name in QUERY_RUNS:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    for name in CYCLE_RUNS:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
