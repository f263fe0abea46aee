"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line with per-query wall-clock seconds (each query fully materialised by a write to
the no-op sink, so every row and column is computed)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peerscope.plans.catalog import REGISTRY  # noqa: E402
from peerscope.session import local_session  # noqa: E402

HEADLINE = [
    "comparables_topn",
    "benchmark_range",
    "benchmark_range_sparse",
    "price_positioning",
    "city_period_summary",
    "neighbourhood_period_summary",
    "feature_frame",
    "model_metrics",
    "price_decisions",
    "data_profile",
    "price_histogram",
    "price_extremes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2), app="peerscope-bench")
    # Warm-up: JVM start, parquet footers.
    REGISTRY["rows_by_city"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
