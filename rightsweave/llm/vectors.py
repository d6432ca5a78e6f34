"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, connected components.

Equal vectors of a label are one representative with a count.  In each table a
representative falls into the bucket of its hyperplane signs; buckets of two
and more are compared exactly in tiles of bounded size, each pair only in the
first table where it meets, so that links are counted without a row per pair.
A tile returns link counts and the edges of a spanning forest of its links,
and the forests of all tiles are joined to connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import identified, ship
from .components import connected_components

#: Members of a bucket that one side of a tile holds at most (on average; buckets are cut by hash).
TILE = 512
#: Linked pairs of a tile whose earlier tables are compared at once.
PAIRS = 32768


def tables_for(n: int, cosine: float, miss: float = 1e-6) -> tuple[int, int]:
    """(bits, tables): about one vector per bucket, and a pair at ``cosine`` missed with probability ``miss``."""
    bits = max(8, math.ceil(math.log2(max(2, n))))
    same = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-min(same, 1 - 1e-12))))


def _signs(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """The bucket number of every vector (row) in every table (column)."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    on = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return on @ (1 << np.arange(bits, dtype=np.int64))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors (rows) in double precision, each by the power of two that brings its largest component to 0.5 to 1.

    Directions stay as they are, to the bit; squares can neither overflow nor vanish.
    """
    vectors = vectors.astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def _packing(reps: DataFrame) -> str:
    """How numpy reads packed vectors: floats as they come, other numbers as doubles."""
    return "<f4" if reps.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"


def signed(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(rep, label, dim, copies, packed, signs) of ``reps`` (rep, label, vector, copies).

    ``packed`` is the vector as binary numbers, ``signs`` its bucket numbers as binary longs.
    """
    packing = _packing(reps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, packing) for v in batch.column(4).to_pylist()]
            signs: list[bytes] = [b""] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                for i, row in zip(at, _signs(_scaled(np.array([vectors[i] for i in at])), bits, tables, seed)):
                    signs[i] = row.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array(signs, pa.binary())],
                ["rep", "label", "dim", "copies", "packed", "signs"])

    kept = reps.select("rep", "label", F.size("vector").alias("dim"), "copies", "vector")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:4])
    return kept.mapInArrow(run, schema + ", packed binary, signs binary")


def _buckets(reps: DataFrame, tables: int) -> DataFrame:
    """(label, dim, table, bucket, rep) of every representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                signs = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i8")
                repeat = pa.array(np.repeat(np.arange(n, dtype=np.int32), tables))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(repeat) for i in range(3)),
                     pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(signs)],
                    ["label", "dim", "rep", "table", "bucket"])

    kept = reps.select("label", "dim", "rep", "signs")
    label = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(run, f"label {label}, dim int, rep bigint, table int, bucket bigint")


def _tiles(buckets: DataFrame) -> DataFrame:
    """(tile, table, cross, side, rep): the members of buckets of two and more, in tiles of two chunks at most.

    ``cross`` tiles compare side 0 with side 1, the others all their members.
    """
    key = ["label", "dim", "table", "bucket"]
    sizes = buckets.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    rows = buckets.join(sizes, key).withColumn("chunks", F.ceil(F.col("n") / TILE).cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("rep", F.lit("chunk")), "chunks").cast("int"))
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return other.select(F.struct(*key, low.alias("low"), high.alias("high")).alias("tile"), "table",
                        (F.col("chunk") != F.col("other")).alias("cross"),
                        (F.col("chunk") > F.col("other")).cast("int").alias("side"), "rep")


def _compare(reps: np.ndarray, copies: np.ndarray, vectors: np.ndarray, signs: np.ndarray, table: int, cross: bool,
             side: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, links, root) of the members with links in a tile; root is the smallest member reached in it."""
    vectors = _scaled(vectors)
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if cross:
        linked &= side[:, None] != side[None, :]
    if table and linked.any():
        before = signs[:, :table]
        pairs = np.argwhere(np.triu(linked))
        for at in range(0, len(pairs), PAIRS):
            i, j = pairs[at:at + PAIRS].T
            met = (before[i] == before[j]).any(1)  # in an earlier table
            linked[i[met], j[met]] = linked[j[met], i[met]] = False
    links = linked @ copies
    root = reps.copy()
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (least == root).all():
            break
        root = least
    at = np.flatnonzero(links)
    return reps[at], links[at], root[at]


def tile_links(tiles: DataFrame, reps: DataFrame, cosine: float, packing: str) -> DataFrame:
    """(rep, links, root) of every tile's members with links; ``reps`` as :func:`signed` gives them."""
    number = F.xxhash64("tile")
    rows = (tiles.join(reps.select("rep", "copies", "packed", "signs"), "rep")
            .select(number.alias("number"), F.to_json("tile").alias("tile"), "table", "cross", "side", "rep", "copies", "packed",
                    "signs").repartition("number", "tile").sortWithinPartitions("number", "tile", "rep", "side"))

    def flush(held: list[tuple]) -> pa.RecordBatch | None:
        if len(held) < 2:
            return None
        table, cross, side, reps_, copies, vectors, signs = zip(*held)
        found = _compare(np.array(reps_, np.int64), np.array(copies, np.int64),
                         np.frombuffer(b"".join(vectors), packing).reshape(len(held), -1), np.frombuffer(b"".join(signs), "<i8").reshape(len(held), -1), table[0], cross[0],
                         np.array(side), cosine)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["rep", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for tile, *member in zip(*(batch.column(i).to_pylist() for i in range(1, 9))):
                if tile != now:
                    out = flush(held)
                    if out is not None and out.num_rows:
                        yield out
                    held, now = [], tile
                held.append(tuple(member))
        out = flush(held)
        if out is not None and out.num_rows:
            yield out

    return rows.mapInArrow(run, "rep bigint, links bigint, root bigint")


def near_vectors(table: DataFrame, cosine: float = 0.98, seed: int = 1, vec_id: str = "vec_id", vector: str = "embedding",
                 label: str = "label", bits: int | None = None, tables: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link at a cosine of at least ``cosine`` in double precision if their
    labels are equal and not null and their vectors equally long; vectors that
    are null, empty, zero or hold a null or non-finite component link with
    nothing.  Repeated ids are rows of their own.  component_id is the smallest
    vec_id reachable; rows with a null id take one from the others of their
    component, and have null, and are kept, if there is none.
    """
    ship(table.sparkSession)
    rows, row = identified(table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                                        F.col(vector).alias("vector")), "vectors")
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    nonzero = F.exists("vector", lambda x: x != 0)
    able = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite & nonzero)
    reps = materialize(able.groupBy("label", "vector").agg(F.min(row).alias("rep"), F.count("*").alias("copies"),
                                                           F.min("vec_id").alias("first")), "representatives")
    auto = tables_for(reps.count(), cosine)
    bits, tables = bits or auto[0], tables or auto[1]
    marked = materialize(signed(reps, bits, tables, seed), "signs")
    found = materialize(tile_links(_tiles(materialize(_buckets(marked, tables), "buckets")), marked, cosine,
                                   _packing(reps)), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    whole = (reps.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("root", F.coalesce("root", "rep"))
             .withColumn("links", F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1))
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = whole.join(least, "root").select("label", "vector", "links", "component_id")
    rest = rows.join(able.select(row), row, "left_anti").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = able.join(whole, ["label", "vector"]).select("vec_id", F.col("links").alias("n_links"), "component_id")
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
