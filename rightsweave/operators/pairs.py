"""Aggregates over overlapping contract pairs (rows ``a`` and ``b`` of ``chains.overlap_sides``).

Sets come as distinct rows, never as one array per contract, so that a
contract with very many partners is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rightsweave.functions.arrays import ROLE_PUBLISHER, first_of, pct_product



def _first() -> Column:
    return F.get(F.col("a.chain"), 0).alias("from_ctr")


def partner_union(sides: DataFrame, values: str, name: str) -> DataFrame:
    """Per contract the distinct elements of its partners' array ``values``."""
    return sides.select(_first(), F.explode(F.col(f"b.{values}")).alias(name)).distinct()


def partner_intersection(sides: DataFrame, values: str, name: str) -> DataFrame:
    """Per contract the elements of its own array ``values`` that a partner has too."""
    return sides.select(_first(), F.explode(F.array_intersect(f"a.{values}", f"b.{values}")).alias(name)).distinct()


def first_percents(sides: DataFrame) -> DataFrame:
    """Per contract and partner role: the first publisher percent, multiplied behind a publisher, and creator percent.

    "First" is the smallest, so that the result does not depend on row order.
    """
    role = first_of("b.assignors", "role")

    def least(side: str, field: str) -> Column:
        return F.min(first_of(f"{side}.assignors", field))

    own, next_ = least("a", "pct_publisher"), least("b", "pct_publisher")
    rows = sides.groupBy(_first(), role.alias("partner_role")).agg(
        own.alias("own"), next_.alias("next"), least("a", "pct_creator").alias("pct_creator"))
    return rows.select("from_ctr", "partner_role", F.when(F.col("partner_role") == ROLE_PUBLISHER, pct_product(
        "own", "next")).otherwise(F.col("own")).alias("pct_publisher"), "pct_creator")
