"""Territory hierarchy: transitive closure, leaf sets, include/exclude fold.

Output tables keep the declared computed schemas of the source system:
``territories(cdepaysiso4n int, cdepaysiso4n_fils array<int>)`` and
``territories_by_id_tercmplx(idtercmplx int, territoires array<int>)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rightsweave.session import materialize

PARENT = "cdepaysiso4npere"
CHILD = "cdepaysiso4nfils"


def closure(edges: DataFrame, parent: str = PARENT, child: str = CHILD) -> DataFrame:
    """All (ancestor, descendant) pairs of a parent->child edge table.

    Semi-naive doubling: each round joins the pairs found in the previous
    round with all known pairs and keeps those not known yet (anti join), so
    the reach doubles, cycles end, and a hierarchy of any depth needs a
    logarithmic number of rounds.  Only the new pairs of a round are written
    to the shared folder; the known set is the union of those disjoint,
    already written deltas.  The loop ends on an empty delta.
    """
    step = edges.select(F.col(parent).alias("ancestor"), F.col(child).alias("descendant")) \
        .where(F.col("ancestor").isNotNull() & F.col("descendant").isNotNull()).distinct()
    deltas = [materialize(step, "closure_edges")]
    while True:
        known = reduce(DataFrame.unionByName, deltas)
        nxt = (
            deltas[-1].alias("d").join(known.alias("e"), F.col("d.descendant") == F.col("e.ancestor"))
            .select(F.col("d.ancestor"), F.col("e.descendant"))
            .distinct()
            .join(known, ["ancestor", "descendant"], "left_anti")
        )
        nxt = materialize(nxt, "closure_delta")
        if nxt.isEmpty():
            return known
        deltas.append(nxt)


def leaves(edges: DataFrame, parent: str = PARENT, child: str = CHILD) -> DataFrame:
    """Territories that are never a parent (anti join), one row each.

    Both sides are made distinct first, the children written: the anti join
    would else be pushed below the union that the edges are made of, and one
    task would sort every part of it with all parents.
    """
    children = materialize(edges.select(F.col(child).alias("leaf")).where(F.col("leaf").isNotNull()).distinct(),
                           "territory_children")
    parents = edges.select(F.col(parent).alias("leaf")).distinct()
    return children.join(parents, "leaf", "left_anti")


def leaf_sets(edges: DataFrame, parent: str = PARENT, child: str = CHILD,
              pairs: DataFrame | None = None) -> DataFrame:
    """Territory -> sorted set of its leaf countries; a leaf maps to itself."""
    pairs = closure(edges, parent, child) if pairs is None else pairs
    lv = materialize(leaves(edges, parent, child), "territory_leaves")
    inner = (
        pairs.join(lv, pairs.descendant == lv.leaf)
        .groupBy(F.col("ancestor").alias("cdepaysiso4n"))
        .agg(F.sort_array(F.collect_set("leaf")).alias("cdepaysiso4n_fils"))
    )
    own = lv.select(F.col("leaf").alias("cdepaysiso4n"), F.array(F.col("leaf")).alias("cdepaysiso4n_fils"))
    return inner.unionByName(own)


def _element_leaves(elements: DataFrame, territories: DataFrame) -> DataFrame:
    """One row per (complex territory, element, leaf); unknown territories drop.

    The elements are dealt out before their leaves are listed: the join
    leaves those of a much used territory (the world) in one task.  The number
    of shares is given, as AQE would merge them by their size before the listing.
    """
    shares = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        elements.select("idtercmplx", "cdepaysiso4n", "incl", "ord_list")
        .join(territories.select("cdepaysiso4n", "cdepaysiso4n_fils"), "cdepaysiso4n")
        .repartition(shares, "idtercmplx", "cdepaysiso4n")
        .select("idtercmplx", "ord_list", "incl", F.explode("cdepaysiso4n_fils").alias("leaf"))
    )


def fold(elements: DataFrame, territories: DataFrame) -> DataFrame:
    """Fold ordered include/exclude elements into a final country set.

    Elements are applied in ``(ord_list, incl)`` order; a non-zero ``incl``
    adds the element's leaves, zero removes them.  Equivalent relational
    form: a leaf is in the result iff the last element touching it (by that
    order) is an include.  ``max_by`` finds that element per (territory,
    leaf) with map-side partial aggregation, so a territory with very many
    elements never sits whole in one task.  A territory whose elements cancel
    out keeps its row with an empty array.
    """
    last = (
        _element_leaves(elements, territories)
        .groupBy("idtercmplx", "leaf")
        .agg(F.max_by(F.coalesce(F.col("incl") != 0, F.lit(False)),
                      F.struct("ord_list", "incl")).alias("keep"))
    )
    return (
        last.groupBy("idtercmplx")
        .agg(F.sort_array(F.collect_set(F.when(F.col("keep"), F.col("leaf")))).alias("territoires"))
    )


def last_states(elements: DataFrame, territories: DataFrame) -> DataFrame:
    """(idtercmplx, leaf, final_incl): last 0/1 state per leaf by element order.

    Ordered window per (territory, leaf) taking the last value over the whole
    frame, then one row per key.
    """
    w = (Window.partitionBy("idtercmplx", "leaf").orderBy("ord_list", "incl")
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    state = F.last(F.when(F.col("incl").isin(0, 1), F.col("incl")), ignorenulls=True).over(w)
    return (
        _element_leaves(elements, territories)
        .withColumn("final_incl", state)
        .dropDuplicates(["idtercmplx", "leaf"])
        .select("idtercmplx", "leaf", "final_incl")
    )


def fold_window(elements: DataFrame, territories: DataFrame) -> DataFrame:
    """Same fold written with ordered windows: the last 0/1 state per leaf.

    ``incl == 1`` adds and ``incl == 0`` removes; other values leave the
    state unchanged.  The window runs per (territory, leaf), so a frame
    holds only the elements touching one leaf, never a whole territory.
    """
    return (
        last_states(elements, territories).groupBy("idtercmplx")
        .agg(F.sort_array(F.collect_set(F.when(F.col("final_incl") == 1, F.col("leaf"))))
             .alias("territoires"))
    )


def contains_country(territory_sets: DataFrame, country) -> DataFrame:
    """Complex territories whose set contains ``country`` (FLT-5)."""
    return territory_sets.where(F.coalesce(F.array_contains("territoires", country), F.lit(False)))


def compute_territories(gpeter: DataFrame, eltter: DataFrame) -> dict[str, DataFrame]:
    """Both computed territory tables from the raw hierarchy and elements."""
    sets = leaf_sets(gpeter)  # small; recomputed from the written closure when reused
    by_id = fold(eltter, sets)
    return {"territories": sets, "territories_by_id_tercmplx": by_id}
