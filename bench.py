"""Headline-query timings: one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query is planned from scratch and fully executed with the `noop` sink
(no collect to the driver); one warm-up run, then the median of
BENCH_RUNS timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "c02_load_flow",            # raw transactions -> monthly flow (filter, parse, conditional aggregate)
    "c05_panel_features",       # gap-filled grid + past-only window features
    "a15_error_metrics",        # flagship slice: flow -> features -> splits -> baseline scores
    "c01_load_stock",           # 5-way join, dedupe by key, tiered exact medians, stock aggregate
    "v00_report",               # all row-quality checks, one scan per dataset
    "c16_opportunity_score",    # supply roll-up, ZIP majority, windows, distributed percentile ranks
    "m17_conformal_intervals",  # volume terciles + split-conformal order statistics
    "m13_model_selection",      # per-series rolling folds x closed-form models
    "a16_entity_errors",        # per-entity error table
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from panelspark.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(4, cpus * 2), app="panelspark-bench")
    from panelspark.plans import catalog
    catalog.load_all()
    times = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus,
                      "runs": runs}))


if __name__ == "__main__":
    main()
