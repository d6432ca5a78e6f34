"""End-to-end jobs composed from the plans (what a scheduled run executes)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rightsweave.plans import chains, contracts, restitution, territories
from rightsweave.session import materialize, materialize_alone, tracked


def territory_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Computed territory tables, materialised once for all later joins."""
    out = territories.compute_territories(tables["gpeter"], tables["eltter"])
    out["territories_by_id_tercmplx"] = materialize(out["territories_by_id_tercmplx"],
                                                    "territories_by_id_tercmplx")
    return out


def chain_table(tables: dict[str, DataFrame], consult_date, max_depth: int,
                terr: dict[str, DataFrame] | None = None, mode: str = "pivot",
                base: DataFrame | None = None) -> DataFrame:
    """Contract chains up to ``max_depth`` levels (``mode``: pivot or path), from ``base`` where given."""
    if base is None:
        terr = terr or territory_tables(tables)
        base = contracts.contract_base(tables, terr["territories_by_id_tercmplx"], consult_date)
    if mode == "path":
        return chains.paths(base, max_depth)
    return chains.build(base, max_depth)


def flat_chain_table(tables: dict[str, DataFrame], terr: dict[str, DataFrame], consult_date, max_depth: int) -> DataFrame:
    """The chain table in scalar shape, written as it is read twice; what was written on the way is deleted."""
    return materialize_alone(lambda: chains.flatten(chain_table(tables, consult_date, max_depth, terr)),
                             tables["contrat"].sparkSession, "flat_chains")


def restitution_job(tables: dict[str, DataFrame], requests: DataFrame, consult_date, max_depth: int,
                    request_keys: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Chains for ``consult_date`` then restitution for every request row."""
    with tracked() as paths:
        terr = territory_tables(tables)
        chain_rows = flat_chain_table(tables, terr, consult_date, max_depth)
        keys = restitution.static_keys(tables, terr["territories_by_id_tercmplx"], requests, request_keys,
                                       keep_territories=False)
    return restitution.restitution(chain_rows, keys, request_keys, strict, release=paths)


def contract_base_of_day(tables: dict[str, DataFrame], root: str, consult_date,
                         terr: dict[str, DataFrame] | None = None) -> DataFrame:
    """Contract base for ``consult_date``: read from ``root`` when already
    written that day, else assembled, written and read back (as a snapshot table)."""
    from rightsweave.sources import io, snapshots

    spark = tables["contrat"].sparkSession
    path = io.dated_path(root, "contract_base", 0, consult_date)

    def compute():
        t = terr or territory_tables(tables)
        return contracts.contract_base(tables, t["territories_by_id_tercmplx"], consult_date)

    return snapshots.read_or_compute(spark, path, compute)
