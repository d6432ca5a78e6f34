"""Hot-key probe: restitution when one work holds a third of all owner rows.

Runs ``rst_restitution`` on the normal demo world and on a variant where
every third lineitem's part (work) is replaced by work 2, and reports wall
time and the longest single task of each run (from Spark's event log in a
scratch folder).  With ``chn_build`` as second argument, every third contract assigns to one
catalog instead (a hot key of the overlap join).
Usage: python scripts/skew_probe.py /root/testdata/sf0.1 [rst_restitution|chn_build]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from rightsweave import registry  # noqa: E402
from rightsweave.sources import world as W  # noqa: E402

HOT_WORK = 2
HOT = f"CASE WHEN l_orderkey % 3 = 0 THEN {HOT_WORK} ELSE l_partkey END"


def longest_task(ev_dir: str) -> float:
    best = 0.0
    for f in glob.glob(f"{ev_dir}/*/events_*") + glob.glob(f"{ev_dir}/events_*"):
        with open(f, "rb") as fh:
            for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8"):
                e = json.loads(line)
                if e.get("Event") == "SparkListenerTaskEnd":
                    ti = e["Task Info"]
                    best = max(best, (ti["Finish Time"] - ti["Launch Time"]) / 1000)
    return best


HOT_CATALOG = "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_orderkey + 1 END"


def run(sf: str, hot: bool, query: str = "rst_restitution") -> dict:
    ev = tempfile.mkdtemp(prefix="run-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
             .config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    saved = dict(W._WORLD_SQL)
    if hot and query == "rst_restitution":
        for t in ("partpt", "ayant_droit", "restroeuv"):
            W._WORLD_SQL[t] = W._WORLD_SQL[t].replace("l_partkey", HOT)
    elif hot:
        # every third contract assigns to catalog 7 (contract 7's own catalog)
        W._WORLD_SQL["detcess"] = W._WORLD_SQL["detcess"].replace("o_orderkey + 1 AS numcatal",
                                                                  f"{HOT_CATALOG} AS numcatal")
    try:
        registry.ter_leaves(spark, sf).collect()
        t0 = time.perf_counter()
        df = registry.QUERIES[query](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        if query == "rst_restitution":
            hot_rows = df.where(f"ide12 = {HOT_WORK}").count()
        else:
            hot_rows = df.where("chain_key LIKE '%|7' OR chain_key LIKE '%|7|%'").count()
    finally:
        W._WORLD_SQL.clear()
        W._WORLD_SQL.update(saved)
        spark.stop()
    return {"query": query, "hot": hot, "sec": round(wall, 1), "rows_of_hot_key": hot_rows,
            "longest_task_sec": longest_task(ev)}


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    which = sys.argv[2] if len(sys.argv) > 2 else "rst_restitution"
    print(json.dumps([run(sf, False, which), run(sf, True, which), run(sf, False, which)]))
