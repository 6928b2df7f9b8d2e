"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Each query is executed in full with the ``noop`` sink (every
row produced, nothing collected to the driver). ``queries`` has the second,
warm run, without JVM start-up and code generation; ``cold`` has the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

BENCH_QUERIES = [
    "filing_verdict_counts",
    "catalog_project",
    "discovery_matrix",
    "name_history",
    "index_diff",
    "fact_dedupe",
    "fact_table",
    "fact_ffill",
    "descendants",
    "golden_record",
    "master_sync",
    "audit_report",
    "text_normalize",
    "text_strip_html",
    "stream_dedup",
    "bin_upsert",
    "fact_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from kaiji.session import build_session
    from kaiji.plans import registry

    spark = build_session(f"local[{cpus}]", app="kaiji-bench", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    names = [n for n in BENCH_QUERIES if n in qs]
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        for run in (cold, times):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            run[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cold": cold, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
