"""Join helpers.

``salted_join`` spreads the heavy keys of the large side over several tasks and
leaves all others alone.  One pass over the key columns keeps a frequent-items
sketch (map-side partial sketches, merged once) that names the keys with more
than a ``1/buckets`` share of the rows.  A heavy key gets as many salts as it
holds such shares: rows of the large side take one of them by a hash of the row
(so a retried task after a lost executor produces the same salt – a random salt
would not; equal rows share a salt), rows of the small side are copied once per
salt of their key, and rows of other keys not at all.  The result equals the
plain equi-join whatever the sketch says; its error moves only the balance.
With AQE's skew-join handling enabled (the default of
:func:`rightsweave.session.build_session`) a plain join is usually enough;
the salted form is for plans where AQE cannot split (e.g. the skewed side is
the build side of a shuffled hash join, or AQE is off).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that the sketch tracks for each bucket; its error is about a twentieth of a bucket's share of the rows.
TRACKED = 64


def heavy_keys(rows: DataFrame, keys: list[str], buckets: int = 16) -> DataFrame:
    """``(_key, salts)``: hash and number of shares of every key with more than ``1/buckets`` of the rows.

    Fewer than ``buckets`` keys can hold so many, so the result is bounded.
    Rows with a null in a key count as a key of their own.
    """
    found = rows.select(F.xxhash64(*keys).alias("_key")).agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(_key, {buckets}, {TRACKED * buckets})").alias("top"))
    return (found.select("rows", F.inline("top"))
            .select(F.col("item").alias("_key"), F.ceil(F.col("count") * buckets / F.col("rows")).cast("int").alias("salts"))
            .where("salts > 1"))


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], buckets: int = 16,
                how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with the heavy keys of the large side salted, ``buckets`` shares of its rows at most."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins (large side preserved)")
    for k in keys:
        if large.schema[k].dataType != small.schema[k].dataType:
            raise ValueError(f"key {k!r} has two types; cast one side")
    heavy = F.broadcast(heavy_keys(large, keys, buckets))  # fewer than ``buckets`` rows

    def with_salts(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_key", F.xxhash64(*keys)).join(heavy, "_key", "left").drop("_key").withColumn(
            "salts", F.coalesce("salts", F.lit(1)))

    own = F.pmod(F.xxhash64(*[F.col(c) for c in large.columns]), F.col("salts")).cast("int")
    salted = with_salts(large).withColumn("_salt", own).drop("salts")
    copied = with_salts(small).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return salted.join(copied, keys + ["_salt"], how).drop("_salt")
