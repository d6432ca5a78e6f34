"""Overlap pairs through catalogs as hubs, formed only where the chain survives.

A catalog that is assignee of many contracts and assignor of many others
links every one of the first to every one of the second, although most of
those chains may be void.  Whether a pair survives depends only on the
*signature* of its rows: the three inclusive restriction lists and the
territories.  The join is therefore factorised at the catalog:

1. each row goes to its hubs as (hub, signature), once as assignor side and
   once as assignee side; equal signatures of a hub are one entry;
2. the entries of a hub meet by equi-keys (hub, which restriction lists are
   empty, an included work) and stay where the other lists and the
   territories overlap;
3. rows are joined to the entries that stayed, first the left, then the
   right ones, so every row formed belongs to a pair that survives.

Rows with a null list or without territory survive with nobody.  Pairs that
share several catalogs or works are one pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rightsweave.session import materialize

_RESTRICTIONS = ("genre_incl", "catalog_incl", "work_incl")
_SIGNATURE = (*_RESTRICTIONS, "territories")


def _signatures(*sides: DataFrame) -> DataFrame:
    """Distinct signatures of rows that may survive, with a number given when they are written."""
    usable = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in _RESTRICTIONS], F.size("territories") > 0)
    found = reduce(DataFrame.union, [s.where(usable).select(*_SIGNATURE) for s in sides]).distinct()
    return materialize(found.withColumn("sid", F.monotonically_increasing_id()), "signatures")


def _signed(rows: DataFrame, signatures: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows with the number of their signature and their catalogs on both sides, written: whole lists are shuffled once."""
    return materialize(rows.join(signatures, list(_SIGNATURE)).select(
        *keys, "rid", "sid", *(c for c in ("assignable", "assignees", "assignors") if c in rows.columns)), "signed_rows")


def _members(rows: DataFrame, signatures: DataFrame, catalogs: str, keys: tuple[str, ...]) -> DataFrame:
    """(keys, hub, rid, sid) of every row and each of its catalogs; rows of :func:`_signed` have their ``sid``."""
    signed = rows if "sid" in rows.columns else rows.join(signatures, list(_SIGNATURE))
    return (signed.select(*keys, "rid", "sid", F.explode(F.array_distinct(catalogs)).alias("hub"))
            .where("hub is not null"))


def _entries(members: DataFrame, signatures: DataFrame, keys: tuple[str, ...], side: str) -> DataFrame:
    """Distinct (keys, hub, signature) with the lists, one row for each included work (one without any)."""
    empty = [F.when(F.size(c) == 0, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(_RESTRICTIONS)]
    return (members.select(*keys, "hub", "sid").distinct().join(signatures, "sid")
            .select(*keys, "hub", F.col("sid").alias(f"{side}_sid"),
                    reduce(Column.__add__, empty).alias("open_lists"),
                    *[F.col(c).alias(f"{side}_{c}") for c in ("genre_incl", "catalog_incl", "territories")],
                    F.explode_outer(F.array_distinct("work_incl")).alias("work")))


def _meets(name: str) -> Column:
    return F.arrays_overlap(f"a_{name}", f"b_{name}")


def live_entries(left: DataFrame, right: DataFrame, signatures: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, hub, a_sid, b_sid) of the signatures that meet at a hub and make no void chain."""
    a, b = (_entries(m, signatures, keys, s).alias(s) for m, s in ((left, "a"), (right, "b")))
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*keys, "hub", "open_lists")],
                  F.col("a.work").eqNullSafe(F.col("b.work")))
    unrestricted = F.col("a.open_lists").bitwiseAND(1) > 0, F.col("a.open_lists").bitwiseAND(2) > 0
    survives = (unrestricted[0] | _meets("genre_incl")) & (unrestricted[1] | _meets("catalog_incl")) & _meets("territories")
    return a.join(b, same & survives).select(*(F.col(f"a.{k}") for k in keys), "a.hub", "a_sid", "b_sid").distinct()


def surviving_pairs(rows: DataFrame, keys: tuple[str, ...] = (), right: DataFrame | None = None) -> DataFrame:
    """Row-id pairs (a_rid, b_rid) whose catalogs overlap and whose chain is neither void nor without territory.

    ``rows`` have ``rid``, and so has ``right`` (``rows`` where not given).
    """
    other = rows if right is None else right
    signatures = _signatures(*[rows] if right is None else [rows, right])
    signed = _signed(rows, signatures, keys)
    a = _members(signed.where(F.col("assignable") == 1), signatures, "assignees.catalog", keys)
    b = _members(signed if right is None else other, signatures, "assignors.catalog", keys)
    live = live_entries(a, b, signatures, keys)
    at = [*keys, "hub"]
    reached = (a.withColumnsRenamed({"rid": "a_rid", "sid": "a_sid"}).join(live, [*at, "a_sid"])
               .select(*at, "a_rid", "b_sid").distinct())
    return (reached.join(b.withColumnsRenamed({"rid": "b_rid", "sid": "b_sid"}), [*at, "b_sid"])
            .select("a_rid", "b_rid").distinct())
