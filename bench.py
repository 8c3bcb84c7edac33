"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the local threads, BENCH_QUERIES an
optional comma-separated choice (``all`` for every query), BENCH_RUNS the timed
runs after one warm-up. Each run builds the query and computes every output
column; the figure is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from conduit.plans import catalogue  # noqa: E402
from conduit.session import release_scratch  # noqa: E402

HEADLINE = (
    "hourly_counters_by_predicate",
    "prd03_boolean_logic",
    "prd07_rule_set",
    "rec07_row_to_json",
    "rec08_json_to_row",
    "rec12_pagination",
    "typ00_six_types",
    "src04_line_framing",
    "jon01_changed_rows",
    "jon02_route_exact",
    "jon04_keyed_lookup",
    "jon06_route_exchange",
    "agg01_identity_statistics",
    "agg02_duplicate_keys",
    "agg04_hash_counters",
    "agg04_running_counter",
    "agg07_last_write",
    "agg09_expiring_log_fold",
    "enc01_base64_encode",
    "enc06_aes_chain",
    "net04_split_uri",
    "sql01_parameterised",
    "srt02_limit",
    "txt01_listing_lines",
    "txt02_element_responses",
    "txt04_fixed_layout",
    "snk01_bulk_copy",
    "stm08_hourly_counters",
    "stm09_live_statistics",
    "stm10_live_hashes",
)


def run(spark: SparkSession, name: str, folder: str) -> float:
    started = time.perf_counter()
    catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(catalogue.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("conduit-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    release_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, median per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
