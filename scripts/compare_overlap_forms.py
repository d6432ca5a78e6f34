"""Time the array-overlap join as written in the source system (theta join on
``size(array_intersect(...)) > 0``, planned as a nested-loop/cartesian join)
against the exploded equi-join used by the library.  Both count the same pairs.

Usage: python scripts/compare_overlap_forms.py /root/testdata/sf0.01
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rightsweave import registry  # noqa: E402
from rightsweave.plans import chains, contracts  # noqa: E402
from rightsweave.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    _, base = registry._base(spark, sf)
    base = chains.with_row_id(base.select(*contracts.CHAIN_COLUMNS).dropDuplicates())
    base.count()
    t0 = time.perf_counter()
    eq = chains.overlap_pairs(base).count()
    t_eq = time.perf_counter() - t0
    a = base.where(F.col("assignable") == 1).select(F.col("rid").alias("a_rid"), F.col("assignees.catalog").alias("ac"))
    b = base.select(F.col("rid").alias("b_rid"), F.col("assignors.catalog").alias("bc"))
    theta = a.join(b, F.size(F.array_intersect("ac", "bc")) > 0).select("a_rid", "b_rid").distinct()
    plan = theta._jdf.queryExecution().executedPlan().toString()
    t0 = time.perf_counter()
    th = theta.count()
    t_th = time.perf_counter() - t0
    print(json.dumps({"sf_dir": sf, "pairs_equi": eq, "pairs_theta": th, "sec_equi": round(t_eq, 2),
                      "sec_theta": round(t_th, 2),
                      "theta_plan": "BroadcastNestedLoopJoin" if "NestedLoop" in plan else
                      ("CartesianProduct" if "Cartesian" in plan else "other")}))


if __name__ == "__main__":
    main()
