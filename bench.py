"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no driver
collect), once in a warm-up pass over all queries and then ``BENCH_RUNS`` (default 5) times; the median is
reported.  ``value`` is the sum of the medians.  ``plan_construction_sec``
shows how much of each is building the DataFrame plan on the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from popspark.plans import catalog  # noqa: E402
from popspark.session import local_session  # noqa: E402

HEADLINE = [
    "pipeline_1970",
    "pipeline_1980",
    "pipeline_1990",
    "pipeline_2000",
    "pipeline_2010",
    "pipeline_2020",
    "full_product",
    "scan_csv_preamble",
    "scan_whitespace",
    "scan_csv_missing_tokens",
    "unpivot_race_sex",
    "agg_county_band",
]


def run_once(spark, name: str, sf: str) -> tuple[float, float]:
    """(total seconds, of which building the plan on the driver)."""
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, t1 - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    for name in names:  # warm-up pass over every query: JIT, file listing, codegen caches
        run_once(spark, name, sf)
    results, construct = {}, {}
    for name in names:
        timings = [run_once(spark, name, sf) for _ in range(runs)]
        results[name] = round(statistics.median(t for t, _ in timings), 3)
        construct[name] = round(statistics.median(c for _, c in timings), 3)
    sf_label = os.path.basename(os.path.normpath(sf)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": sf_label,
                "cpus": cpus,
                "runs": runs,
                "plan_construction_sec": construct,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
