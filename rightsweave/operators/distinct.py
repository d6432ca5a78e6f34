"""Distinct rows without shuffling whole rows.

A wide row is only shuffled where another row has the same 64-bit hash: rows
with a hash of their own differ from all others.  The hashes are counted
first (eight bytes a row).  Those that occur again set a bit in a map of
fixed size, which every task holds however many they are, and the rows whose
bit is set, equal ones among them, are made distinct by their content.  The
result is that of ``dropDuplicates`` whatever the hashes are; a row that
shares its bit with a repeated one is shuffled without need.  Where no hash
occurs again, the rows are returned as they were written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rightsweave.session import discard, materialize, tracked

#: Words of 64 bits in the map of repeated hashes; a few dozen MB at most where it is broadcast.
MAP_WORDS = 1 << 20


def _word() -> Column:
    return F.shiftrightunsigned("_hash", 6).bitwiseAND(F.lit(MAP_WORDS - 1))


def _bit() -> Column:
    return F.col("_hash").bitwiseAND(F.lit(63)).cast("int")


def _repeated(hashed: DataFrame, name: str) -> DataFrame | None:
    """Map of the values of ``_hash`` that occur again in written rows; None where all differ."""
    again = hashed.groupBy("_hash").count().where("count > 1").select(_word().alias("_word"), _bit().alias("_bit"))
    words = materialize(again.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "_bit"))
                                                   .alias("_bits")), f"{name}_hashes")
    return None if words.isEmpty() else words


def _dropped(hashed: DataFrame, words: DataFrame) -> DataFrame:
    may_repeat = (_word() == F.col("_word")) & (F.getbit("_bits", _bit()) == 1)
    alike = hashed.join(F.broadcast(words), may_repeat, "left_semi").dropDuplicates()
    return hashed.join(F.broadcast(words), may_repeat, "left_anti").unionByName(alike).drop("_hash")


def without_repeats(rows: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Distinct rows of ``rows``, which is read three times and should be written already.

    ``by``: columns that are hashed (all if not given); few narrow ones that
    seldom repeat spare reading the others only to hash them.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*(by or rows.columns)))
    words = _repeated(hashed, name)
    return rows if words is None else _dropped(hashed, words)


def distinct_rows(df: DataFrame, name: str, again: bool = False) -> DataFrame:
    """Distinct rows of ``df``, written once as they come with their hashes.

    ``again``: the rows are read several times, so where some repeat the
    distinct ones are written in place of the first ones.  Readers then find
    plain rows, not a union that joins are pushed below and shuffled twice for.
    """
    with tracked() as paths:
        hashed = materialize(df.withColumn("_hash", F.xxhash64(*df.columns)), name)
        words = _repeated(hashed, name)
    if words is None:
        return hashed.drop("_hash")
    if not again:
        return _dropped(hashed, words)
    rows = materialize(_dropped(hashed, words), f"distinct_{name}")
    discard(df.sparkSession, paths)
    return rows


def identified_rows(df: DataFrame, name: str, row_id: str) -> DataFrame:
    """Distinct rows of ``df`` with a number of their own in ``row_id``, given when they are written.

    They are written once, and again only where some repeat.
    """
    number = F.monotonically_increasing_id()
    hashed = materialize(df.withColumn("_hash", F.xxhash64(*df.columns)).withColumn(row_id, number), name)
    words = _repeated(hashed, name)
    if words is None:
        return hashed.drop("_hash")
    return materialize(_dropped(hashed.drop(row_id), words).withColumn(row_id, number), f"identified_{name}")
