"""Batch jobs for ``spark-submit``.

::

    spark-submit rightsweave/cli.py chains --tables DIR --out ROOT [--format csv|parquet]
        [--date YYYY-MM-DD] [--max-depth 4] [--mode pivot|path]
    spark-submit rightsweave/cli.py restitution --tables DIR --chains PATH --territories PATH
        --contexts PATH --requests PATH --out ROOT [--name NAME] [--date YYYY-MM-DD] [--overwrite]
        [--format csv|parquet] [--strict]

``chains`` reads the contract tables (``DIR/<table>`` Parquet folders, or
``DIR/<table>.csv`` with the declared schemas), computes the territory tables
and the contract base once per day (compute-if-absent under
``ROOT/computed/<date>``), builds the chain table and writes it flattened to
``ROOT/chains_depth_<d>_<date>``, partitioned by right type.  ``restitution``
reads the work tables, that chain output, a context table and request rows
``(ide12, num_contexte)`` and writes the restitution of every request to
``ROOT/<name>_<date>``; a result that is there already is only replaced with
``--overwrite``.  A job that ends well deletes its intermediates.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rightsweave.plans import chains, jobs, restitution, territories  # noqa: E402
from rightsweave.session import build_session, discard_intermediates  # noqa: E402
from rightsweave.sources import io, snapshots  # noqa: E402
from rightsweave.sources.schemas import CHAIN_TABLES, RESTITUTION_TABLES, SCHEMAS  # noqa: E402


def _read(spark, args, names, dedup: bool = False):
    return io.read_tables(spark, args.tables, list(names), SCHEMAS, file_type=args.format, dedup=dedup, use_case=args.use_case)


def _write(df, path: str, args, partition_by: str, mode: str) -> None:
    """A plain Parquet folder, or with ``--snapshots`` one more version of a snapshot table."""
    if args.snapshots:
        snapshots.write(df, path, partition_by)
    else:
        io.write_parquet(df, path, partition_by=partition_by, mode=mode)


def _read_one(spark, path: str, name: str):
    if path.endswith(".csv"):
        return io.read_csv(spark, path, SCHEMAS.get(name))
    return spark.read.parquet(path)


def run_chains(spark, args) -> str:
    tables = _read(spark, args, CHAIN_TABLES)
    date = args.date or dt.date.today().isoformat()
    computed = f"{args.out.rstrip('/')}/computed/{date}"
    sets = snapshots.read_or_compute(spark, f"{computed}/territories",
                                     lambda: territories.leaf_sets(tables["gpeter"]))
    by_id = snapshots.read_or_compute(spark, f"{computed}/territories_by_id_tercmplx",
                                      lambda: territories.fold(tables["eltter"], sets))
    base = jobs.contract_base_of_day(tables, computed, date, {"territories_by_id_tercmplx": by_id})
    table = jobs.chain_table(tables, date, args.max_depth, mode=args.mode, base=base)
    out = io.dated_path(args.out, "chains", args.max_depth, date)
    _write(chains.flatten(table), out, args, "right_type", "overwrite")
    return out


def run_restitution(spark, args) -> str:
    tables = _read(spark, args, RESTITUTION_TABLES, dedup=True)
    flat = snapshots.read_any(spark, args.chains)
    by_id = snapshots.read_any(spark, args.territories)
    contexts = _read_one(spark, args.contexts, "contexts")
    requests = _read_one(spark, args.requests, "requests").select("ide12", "num_contexte")
    req = requests.join(contexts, "num_contexte")
    keys = restitution.static_keys(tables, by_id, req, ["num_contexte"], keep_territories=False)
    result = restitution.restitution(flat, keys, ["num_contexte"], strict=args.strict)
    out = f"{args.out.rstrip('/')}/{args.name}_{args.date or dt.date.today().isoformat()}"
    _write(result, out, args, "num_contexte", "overwrite" if args.overwrite else "errorifexists")
    return out


def main(argv: list[str] | None = None, spark=None) -> str:
    p = argparse.ArgumentParser(prog="rightsweave")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("chains")
    c.add_argument("--tables", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    c.add_argument("--date")
    c.add_argument("--max-depth", type=int, default=4)
    c.add_argument("--mode", default="pivot", choices=("pivot", "path"))
    r = sub.add_parser("restitution")
    r.add_argument("--tables", required=True)
    r.add_argument("--chains", required=True)
    r.add_argument("--territories", required=True, help="territories_by_id_tercmplx written by the chains job")
    r.add_argument("--contexts", required=True)
    r.add_argument("--requests", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    r.add_argument("--name", default="restitution")
    r.add_argument("--date")
    r.add_argument("--overwrite", action="store_true")
    r.add_argument("--strict", action="store_true")
    for job in (c, r):
        job.add_argument("--use-case", help="folder below --tables that holds the tables of one case")
        job.add_argument("--snapshots", action="store_true", help="write versions of a snapshot table, never replace one")
    args = p.parse_args(argv)
    own = spark is None
    spark = spark or build_session()
    out = run_chains(spark, args) if args.job == "chains" else run_restitution(spark, args)
    if own:
        discard_intermediates(spark)
    return out


if __name__ == "__main__":
    print(main())
