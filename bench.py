"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed to
completion with the ``noop`` sink (no collect to the driver); the reported time
is the median of ``$BENCH_RUNS`` runs after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = (
    "sales_extract",
    "remove_outliers",
    "continuous_items",
    "price_bands",
    "avg_price",
    "price_bands_multi",
    "avg_price_multi",
    "report_lists_prices",
)


def main() -> None:
    from rosband.plans.registry import owned
    from rosband.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, int(cpus) if cpus != "*" else 8, app="rosband-bench")

    def run(name: str) -> float:
        t = time.perf_counter()
        df, datasets = owned(name, spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t
        datasets.close()  # drop this run's intermediates (not timed)
        return elapsed

    for n in names:  # warm-up: JIT, file listing caches
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(runs)), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
