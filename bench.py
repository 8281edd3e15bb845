"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs its whole plan into Spark's ``noop`` sink (no collect, no
driver transfer); the reported time is the median of ``BENCH_RUNS`` runs after
one warm-up of the flagship.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "reconcile_claims",
    "month_spine_horizon",
    "rate_lookup",
    "rate_lookup_by_month",
    "reconcile_payments",
    "missing_span",
    "payments_monthly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from monthledger.plans.queries import queries
    from monthledger.session import local_session

    spark = local_session(f"local[{cpus}]", "monthledger-bench", **{"spark.driver.memory": "16g"})
    qs = queries()

    def run(name: str) -> float:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run("reconcile_claims")  # warm-up: JVM, code generation, file listing caches
    times = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
