"""Benchmark the headline queries; prints ONE JSON line.

Each query is timed from plan construction to full execution into the
``noop`` sink (every row and column is produced, nothing is collected).
A first pass of every query on the smallest scale factor warms up the JVM
(JIT) and whole-stage codegen, so the timed pass is steady state.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans import queries as Q  # noqa: E402
from stratum.session import build_session  # noqa: E402

HEADLINE = [
    "fact_listing", "dim_outlet", "dim_product", "dim_platform", "valid_portfolio",
    "reject_portfolio", "conform_portfolio", "coverage_audit", "checks_summary", "role_counts",
    "role_visibility", "classify_rules", "label_counts", "sample_scope", "ingest_parsed",
    "ingest_raw", "ingest_stream",
]
# Warm-up data: large enough for the JIT to compile the hot loops.
WARMUP_DIRS = ("/root/testdata/sf0.01", "/root/testdata/sf0.001")


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    warm = next((d for d in WARMUP_DIRS if os.path.isdir(d) and d != sf_dir), None)
    if warm:
        for n in names:
            run(spark, n, warm)
    times = {}
    for n in names:
        times[n] = round(run(spark, n, sf_dir), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
