"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set).
Each query runs to completion through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  A trivial job on generated
rows warms the JVM first; no query result is computed before timing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rightsweave import registry  # noqa: E402
from rightsweave.session import build_session  # noqa: E402

HEADLINE = ("ter_fold", "asm_contract_base", "jn_array_overlap", "chn_build", "rst_restitution",
            "rst_restitution_batch")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    # JVM warm-up only: a trivial job on generated rows, nothing of the queries is computed
    spark.range(1000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
