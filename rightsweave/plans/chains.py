"""Contract chains.

Contract A feeds contract B when one of A's assignee catalogs is one of B's
assignor catalogs and A is assignable.  Chains grow level by level:

* level 1 (:func:`overlap_level`): A ⋈ B on catalog overlap;
* level n+1 (:func:`position_level`): level n joined with itself where the
  element at ``size - n`` of the left chain equals the head of the right one
  (default, "pivot" mode of the source system: only the pivot is compared,
  so ``[a,b,c]`` and ``[b,x,y]`` give ``[a,b,c,x,y]``);
* :func:`path_levels` is the clean mode: extend a chain by one base contract
  whose assignors meet the chain's last assignees, without repeats.

Each level combines the two sides (:func:`combine`) and drops void chains.
Levels are materialised in the shared folder so the plan stays flat and a
lost executor re-reads the previous level instead of recomputing it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from rightsweave.functions.arrays import (
    ROLE_PUBLISHER,
    earlier_end,
    first_of,
    later_start,
    pairwise_pct,
    pct_product,
    restriction_meet,
    restriction_void,
    set_intersect,
    set_union,
)
from rightsweave.operators.distinct import distinct_rows, identified_rows, without_repeats
from rightsweave.plans.contracts import CHAIN_COLUMNS, SCALAR_COLUMNS
from rightsweave.plans.hubs import surviving_pairs
from rightsweave.session import discard, materialize, tracked


def with_row_id(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct chain rows with an identity ``rid``, written once; ``keys`` are columns that chains never cross.

    The id is a number given when the rows are written, never a hash of their
    content, so that no two rows can share it; a frame that already has one
    is returned as it is.
    """
    if "rid" in df.columns:
        return df
    return identified_rows(df.select(*CHAIN_COLUMNS, *keys), "base_rows", "rid")


def combine(a: str = "a", b: str = "b", legacy: bool = False) -> list[Column]:
    """Columns of the chain made of chain ``a`` followed by chain ``b``.

    ``legacy=True`` applies the older rules of the source system: inclusive
    genre and work restrictions are united (not met), inclusive catalogs are
    intersected without voiding, and the percent product is not truncated.
    """
    A = lambda c: F.col(f"{a}.{c}")
    B = lambda c: F.col(f"{b}.{c}")
    pct = F.when(first_of(B("assignors"), "role") == ROLE_PUBLISHER,
                 pairwise_pct(A("assignors"), B("assignors"), truncate=not legacy)).otherwise(A("assignors"))
    genres_works = set_union if legacy else restriction_meet
    void = F.lit(False)
    if not legacy:
        for c in ("genre_incl", "catalog_incl", "work_incl"):
            void = void | restriction_void(A(c), B(c))
    made = {
        "chain": F.array_union(A("chain"), B("chain")),
        "assignors": pct,
        "assignees": B("assignees"),
        "contract_type": A("contract_type"),
        "start_date": later_start(A("start_date"), B("start_date")),
        "end_date": earlier_end(A("end_date"), B("end_date")),
        "assignable": B("assignable"),
        "biem": A("biem"), "idtercess": A("idtercess"), "fledit": A("fledit"),
        "genre_incl": genres_works(A("genre_incl"), B("genre_incl")),
        "genre_excl": set_union(A("genre_excl"), B("genre_excl")),
        "catalog_incl": set_intersect(A("catalog_incl"), B("catalog_incl")),
        "catalog_excl": set_union(A("catalog_excl"), B("catalog_excl")),
        "work_incl": genres_works(A("work_incl"), B("work_incl")),
        "work_excl": set_union(A("work_excl"), B("work_excl")),
        "territories": set_intersect(A("territories"), B("territories")),
        "_void": void,
    }
    return [column.alias(name) for name, column in made.items()]


def keep_valid(df: DataFrame) -> DataFrame:
    """Drop void chains and chains without territory, then duplicates; the rows are written."""
    return distinct_rows(df.where(~F.col("_void") & (F.size("territories") > 0)).drop("_void"), "valid_chains", again=True)


def overlap_pairs(level: DataFrame, keys: tuple[str, ...] = (), right: DataFrame | None = None) -> DataFrame:
    """Row-id pairs (a, b): an assignee catalog of assignable ``a`` is an
    assignor catalog of ``b``, a row of ``level`` or of ``right`` where given, with equal ``keys``.

    Array overlap written as exploded equi-join: both sides are reduced to
    distinct (row, catalog) first, the join runs on the catalog (sort-merge
    or broadcast as AQE sees fit, skewed catalogs split by AQE), and pairs
    sharing several catalogs collapse in a distinct.  No cartesian product.
    """
    left = (level.where(F.col("assignable") == 1)
            .select(*keys, F.col("rid").alias("a_rid"), F.explode("assignees.catalog").alias("catalog"))
            .distinct())
    ends = ((level if right is None else right)
            .select(*keys, F.col("rid").alias("b_rid"), F.explode("assignors.catalog").alias("catalog")).distinct())
    return left.join(ends, [*keys, "catalog"]).select("a_rid", "b_rid").distinct()


def _both_rows(pairs: DataFrame, base: DataFrame, right: DataFrame) -> DataFrame:
    return (pairs.join(base.alias("a"), F.col("a_rid") == F.col("a.rid"))
            .join(right.alias("b"), F.col("b_rid") == F.col("b.rid")))


def overlap_sides(base: DataFrame, keys: tuple[str, ...] = (), right: DataFrame | None = None) -> DataFrame:
    """Every overlapping pair with both rows, as ``a`` and ``b`` (of ``right`` where given, rows with ids too)."""
    base = with_row_id(base, keys)
    return _both_rows(overlap_pairs(base, keys, right), base, base if right is None else right)


def surviving_sides(base: DataFrame, keys: tuple[str, ...] = (), right: DataFrame | None = None) -> DataFrame:
    """Like :func:`overlap_sides`, only the pairs whose chain is kept (formed through catalogs as hubs)."""
    base = with_row_id(base, keys)
    return _both_rows(surviving_pairs(base, keys, right), base, base if right is None else right)


def combined(sides: DataFrame, keys: tuple[str, ...] = (), legacy: bool = False) -> DataFrame:
    """Joined sides as rows of the next level, void ones still marked."""
    return sides.select(*combine("a", "b", legacy), *(F.col(f"a.{k}").alias(k) for k in keys))


def overlap_level(base: DataFrame, legacy: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    """Level 1: pairs of overlapping contracts, combined; pairs that would be void are never formed.

    ``legacy=True``: older combination rules and no void / empty-territory
    filter (the older builder kept every combined pair).
    """
    if legacy:
        return combined(overlap_sides(base, keys), keys, legacy).drop("_void").dropDuplicates()
    base = with_row_id(base, keys)
    with tracked() as paths:
        sides = surviving_sides(base, keys)
    kept = keep_valid(combined(sides, keys))
    discard(base.sparkSession, paths)
    return kept


def position_pairs(level: DataFrame, depth: int, keys: tuple[str, ...] = (), right: DataFrame | None = None) -> DataFrame:
    """Chains ``a`` and ``b`` where the element of ``a`` at ``size - depth`` heads ``b``.

    Left: assignable chains keyed by that element (missing index -> no
    match); right (``level`` again if not given): chains keyed by their head.
    """
    left = level.where(F.col("assignable") == 1) \
        .withColumn("_pivot", F.get(F.col("chain"), F.size("chain") - depth)).alias("a")
    heads = (level if right is None else right).withColumn("_head", F.get(F.col("chain"), 0)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys],
                  F.col("a._pivot") == F.col("b._head"))
    return left.join(heads, same)


def position_level(level: DataFrame, depth: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Level ``depth + 1`` from level ``depth`` (pivot mode)."""
    return keep_valid(combined(position_pairs(level, depth, keys), keys))


def levels(base: DataFrame, max_depth: int, keys: tuple[str, ...] = ()) -> list[DataFrame]:
    """Levels 0..max_depth (pivot mode), each written; stops on an empty level.

    Only rows with equal ``keys`` (e.g. a date segment) are chained.
    """
    base = with_row_id(base, keys)
    current = base.drop("rid")
    out = [current]
    for depth in range(max_depth):
        nxt = overlap_level(base, keys=keys) if depth == 0 else position_level(current, depth, keys)
        out.append(nxt)
        if depth + 1 < max_depth and nxt.isEmpty():  # no check after the last level
            break
        current = nxt
    return out


def union_levels(parts: list[DataFrame], distinct: bool = True) -> DataFrame:
    """Union of written levels by name; ``distinct`` removes rows that several levels have.

    Such rows are looked for by the chain and the columns without lists, so that the lists are not read for it.
    """
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    narrow = ["chain", *(f.name for f in result.schema if not isinstance(f.dataType, ArrayType))]
    return without_repeats(result, "levels", narrow) if distinct else result


def build(base: DataFrame, max_depth: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Chain table: levels 0..max_depth, unioned and deduplicated."""
    return union_levels(levels(base, max_depth, keys))


def path_levels(base: DataFrame, max_depth: int) -> list[DataFrame]:
    """Clean mode: simple paths of up to ``max_depth + 1`` contracts.

    A chain is extended by one base contract ``x`` when the chain is
    assignable, its last assignees meet ``x``'s assignors and ``x`` is not
    already in the chain; percentages are multiplied once per link.
    The contract graph (row-id pairs) is computed once and reused.
    """
    base = with_row_id(base)
    edges = materialize(overlap_pairs(base), "path_edges")
    current = base.withColumn("_last", F.col("rid"))
    out = [base.drop("rid")]
    for depth in range(max_depth):
        step = (current.alias("a")
                .join(edges, F.col("a._last") == F.col("a_rid"))
                .join(base.alias("b"), F.col("b_rid") == F.col("b.rid"))
                .where(~F.array_contains(F.col("a.chain"), F.get(F.col("b.chain"), 0))))
        nxt = step.select(*combine("a", "b"), F.col("b.rid").alias("_last"))
        nxt = keep_valid(nxt)
        out.append(nxt.drop("_last").dropDuplicates())
        if nxt.isEmpty():
            break
        current = nxt
    return out


def paths(base: DataFrame, max_depth: int) -> DataFrame:
    """Chain table in clean mode; levels differ in chain length, so none repeats another's rows."""
    return union_levels(path_levels(base, max_depth), distinct=False)


def flatten(chains: DataFrame) -> DataFrame:
    """One row per (chain, assignor entry, right type, assignee entry).

    Scalar shape consumed by restitution.  Per-chain fan-out is bounded by
    the sizes of the first contract's assignor list and the last one's
    assignee list.
    """
    return (
        chains
        .select("*", F.inline("assignors"))
        .withColumnRenamed("catalog", "assignor_catalog")
        .withColumnRenamed("role", "assignor_role")
        .select("*", F.explode("right_types").alias("right_type"))
        .select("*", F.inline("assignees"))
        .withColumnRenamed("catalog", "assignee_catalog")
        .withColumnRenamed("role", "assignee_role")
        .withColumnRenamed("manager", "assignee_manager")
        .drop("assignors", "assignees", "right_types")
    )


def contract_links(base: DataFrame) -> DataFrame:
    """Distinct overlap links (from_ctr, to_ctr) between the contracts at the heads of ``base``'s rows."""
    base = with_row_id(base)
    ids = base.select("rid", F.get(F.col("chain"), 0).alias("ctr"))
    return (overlap_pairs(base)
            .join(ids.select(F.col("rid").alias("a_rid"), F.col("ctr").alias("from_ctr")), "a_rid")
            .join(ids.select(F.col("rid").alias("b_rid"), F.col("ctr").alias("to_ctr")), "b_rid")
            .select("from_ctr", "to_ctr").distinct())


def overlap_reach(base: DataFrame) -> DataFrame:
    """Contracts reachable from each contract through overlap links, to the fixpoint.

    Pairs ``(from_ctr, to_ctr, hops)`` with the least number of links.  After
    round ``i`` all pairs of up to ``2**i`` links are known; the next round
    continues those of exactly that many links by all known pairs, so the
    reach doubles and the loop ends when no pair is that far apart.  Only the
    new pairs of a round are written; result rows are pairs, never whole
    reachable sets.
    """
    links = materialize(contract_links(base).withColumn("hops", F.lit(1)), "reach_links")
    parts, reach = [links], 1
    while True:
        known = reduce(DataFrame.unionByName, parts)
        far = parts[-1].where(F.col("hops") == reach)
        nxt = (far.alias("f").join(known.alias("k"), F.col("f.to_ctr") == F.col("k.from_ctr"))
               .groupBy(F.col("f.from_ctr"), F.col("k.to_ctr"))
               .agg((F.lit(reach) + F.min("k.hops")).alias("hops"))
               .join(known.select("from_ctr", "to_ctr"), ["from_ctr", "to_ctr"], "left_anti"))
        nxt = materialize(nxt, "reach_delta")
        if nxt.isEmpty():
            return known
        parts.append(nxt)
        reach *= 2


def reach_ends(base: DataFrame) -> DataFrame:
    """Every reachable pair with the assignor catalogs of its first and the assignee catalogs of its last contract."""
    base = with_row_id(base)
    ends = base.select(F.get(F.col("chain"), 0).alias("ctr"), F.col("assignors.catalog").alias("assignor_catalogs"),
                       F.col("assignees.catalog").alias("assignee_catalogs"))
    first = ends.select(F.col("ctr").alias("from_ctr"), "assignor_catalogs").distinct()
    last = ends.select(F.col("ctr").alias("to_ctr"), "assignee_catalogs").distinct()
    return overlap_reach(base).join(first, "from_ctr").join(last, "to_ctr").select(
        "from_ctr", "to_ctr", "hops", "assignor_catalogs", "assignee_catalogs")


def doubling_rounds(df: DataFrame, rounds: int) -> DataFrame:
    """Overlap doubling: each round joins the previous round with itself.

    ``df`` has ``chain`` (contract ids), ``cedant`` and ``cess`` (catalog
    arrays).  Rows ``a``, ``b`` with ``a.cess`` meeting ``b.cedant`` merge to
    ``chain = sorted(a.chain ∪ b.chain)``, ``cedant = (a.cedant ∪ b.cedant)``
    without its last element, ``cess = b.cess``; each round is deduplicated
    and materialised, and all rounds are appended to the input (duplicates
    across rounds kept).  The overlap is an exploded equi-join that carries
    both rows, never a cartesian product.
    """
    current = materialize(df.select("chain", "cedant", "cess"), "doubling_0")
    out = [current]
    for r in range(1, rounds + 1):
        rows = current.distinct()
        left = rows.select(F.col("chain").alias("a_chain"), F.col("cedant").alias("a_cedant"),
                           F.explode(F.array_distinct("cess")).alias("k"))
        right = rows.select(F.col("chain").alias("b_chain"), F.col("cedant").alias("b_cedant"),
                            F.col("cess").alias("b_cess"), F.explode(F.array_distinct("cedant")).alias("k"))
        merged = (left.join(right, "k")
                  .select(F.array_sort(F.array_union("a_chain", "b_chain")).alias("chain"),
                          F.array_union("a_cedant", "b_cedant").alias("cedant"),
                          F.col("b_cess").alias("cess"))
                  .dropDuplicates()
                  .withColumn("cedant", F.slice("cedant", 1, F.greatest(F.size("cedant") - 1, F.lit(0)))))
        current = materialize(merged, f"doubling_{r}")
        out.append(current)
    return union_levels(out, distinct=False)


def scalar_level(level: DataFrame, depth: int) -> DataFrame:
    """Level ``depth + 1`` of the older scalar chains from level ``depth``.

    Level 1 links an assignable row's assignee catalog to an assignor
    catalog; later levels link the last contract of one chain to the head of
    another.  Genres, works, informants and requirements are united, inclusive
    catalogs and territories intersected, the publisher percent is multiplied
    without truncation behind a publisher, and no chain is void.
    """
    a = level.where(F.col("assignable") == 1).alias("a")
    b = level.alias("b")
    if depth == 0:
        joined = a.join(b, F.col("a.assignee_catalog") == F.col("b.assignor_catalog"))
    else:
        joined = a.join(b, F.element_at(F.col("a.chain"), -1) == F.get(F.col("b.chain"), 0))
    made: dict[str, Column] = {c: F.col(f"a.{c}") for c in SCALAR_COLUMNS}
    made |= {c: F.col(f"b.{c}") for c in ("assignee_person", "assignee_catalog", "assignee_role", "assignable")}
    made |= {c: F.array_union(f"a.{c}", f"b.{c}") for c in ("chain", "informants")}
    made |= {c: set_union(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in (
        "genre_incl", "genre_excl", "catalog_excl", "work_incl", "work_excl", "requirements")}
    made |= {c: set_intersect(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in ("catalog_incl", "territories")}
    made["start_date"] = later_start(F.col("a.start_date"), F.col("b.start_date"))
    made["end_date"] = earlier_end(F.col("a.end_date"), F.col("b.end_date"))
    made["pct_publisher"] = F.when(F.col("b.assignor_role") == ROLE_PUBLISHER, pct_product(
        F.col("a.pct_publisher"), F.col("b.pct_publisher"))).otherwise(F.col("a.pct_publisher"))
    return joined.select(*(made[c].alias(c) for c in SCALAR_COLUMNS)).distinct()


def scalar_levels(base: DataFrame, max_depth: int) -> DataFrame:
    """Levels 0..max_depth of the older scalar chains with their level number; equal rows of two levels both stay.

    ``base`` is read once for each side of level 1 and should be written already, as a scalar contract base is.
    """
    current = base.select(*SCALAR_COLUMNS)
    out = [current.withColumn("level", F.lit(0))]
    for depth in range(max_depth):
        current = materialize(scalar_level(current, depth), f"scalar_{depth + 1}")
        out.append(current.withColumn("level", F.lit(depth + 1)))
    return union_levels(out, distinct=False)
