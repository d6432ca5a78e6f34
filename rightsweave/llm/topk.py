"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors of integers are put in an order that keeps similar ones together and
cut into document-range blocks; a segment row holds some blocks with the
largest and smallest value of each component (the term maxima) and the block
forward index.  A query bounds each block by the sum over its components of
the most that the block can add, visits the blocks in falling order of that
bound and scores whole blocks until a bound is below its k-th score.  The k-th
score within the segment that a query itself lies in is where every other
segment starts from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import identified, ship

#: Rows of a block, blocks of a segment and queries of a chunk.
BLOCK, BLOCKS, CHUNK = 256, 16, 256
#: Copies of the queries for each shuffle partition, at most.
COPIES = 4
#: Stands for a null id, which ranks last.
NO_ID = np.iinfo(np.int64).max
#: Below every score.
NONE = np.iinfo(np.int64).min
#: Doubles hold all integers up to here.
EXACT = 1 << 53


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component x; null if the vector or a component is null or not finite."""
    whole = vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(whole, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
    return ids, rows, np.frombuffer(row["vectors"], "<i8").reshape(len(ids), row["dim"])


def _packed(held: list[tuple[int, int, list[int]]], dim: int) -> dict:
    return {"dim": dim, "ids": np.array([h[0] for h in held], "<i8").tobytes(),
            "rows": np.array([h[1] for h in held], "<i8").tobytes(),
            "vectors": np.array([h[2] for h in held], "<i8").reshape(len(held), dim).tobytes()}


def _numbers(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every product sum is exact in doubles, else as Python's integers."""
    most = float(np.abs(vectors.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0))
    kind = float if most * max(1, vectors.shape[1]) < EXACT else object
    return vectors.astype(kind), queries.astype(kind)


class Segment:
    """Blocks of vectors with the extremes of each component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.rows, self.vectors = ids, rows, vectors
        self.cuts = range(0, len(ids), BLOCK)
        self.high = np.array([vectors[a:a + BLOCK].max(0) for a in self.cuts]).reshape(len(self.cuts), vectors.shape[1])
        self.low = np.array([vectors[a:a + BLOCK].min(0) for a in self.cuts]).reshape(len(self.cuts), vectors.shape[1])

    def bounds(self, query: np.ndarray) -> np.ndarray:
        return np.where(query > 0, self.high * query, self.low * query).sum(1)

    def search(self, query: np.ndarray, own: int, k: int, floor: int) -> list[tuple[int, int, int]]:
        """The up to ``k`` best (score, id, row) of at least ``floor``, ties to the smaller id; row ``own`` is left out."""
        bounds = self.bounds(query)
        best: list[tuple[int, int, int]] = []  # (-score, id, row)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] < floor:
                break
            part = slice(self.cuts[b], self.cuts[b] + BLOCK)
            scores = self.vectors[part] @ query
            for i in np.flatnonzero((scores >= floor) & (self.rows[part] != own)):
                at = self.cuts[b] + int(i)
                best.append((-int(scores[i]), int(self.ids[at]), int(self.rows[at])))
            if len(best) >= k:
                best = sorted(best)[:k]
                floor = max(floor, -best[-1][0])
        return [(-s, i, r) for s, i, r in sorted(best)[:k]]


def segments(vectors: DataFrame) -> DataFrame:
    """Segment rows (dim, ids, rows, vectors) of (id, row, vector), similar vectors near each other."""
    ship(vectors.sparkSession)
    signs = F.concat_ws("", F.transform(F.slice("vector", 1, 24), lambda x: F.when(x < 0, "0").otherwise("1")))
    ordered = vectors.select(F.size("vector").alias("dim"), F.coalesce("id", F.lit(int(NO_ID))).alias("id"), "row", "vector",
                             signs.alias("signs")).repartitionByRange("dim", "signs", "id", "row").sortWithinPartitions(
        "dim", "signs", "id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, dim = [], None
        for batch in batches:
            for d, i, r, v in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held and (d != dim or len(held) >= max(BLOCK, min(BLOCK * BLOCKS, (1 << 19) // max(1, d)))):
                    yield pa.RecordBatch.from_pylist([_packed(held, dim)], _SEGMENT)
                    held = []
                dim = d
                held.append((i, r, v))
        if held:
            yield pa.RecordBatch.from_pylist([_packed(held, dim)], _SEGMENT)

    return ordered.mapInArrow(run, "dim int, ids binary, rows binary, vectors binary")


_SEGMENT = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("vectors", pa.binary())])
_CHUNK = pa.schema([*_SEGMENT, ("floors", pa.binary())])
_HIT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()),
                  ("score", pa.int64())])


def _chunks(segments: DataFrame, k: int, every: int) -> DataFrame:
    """Rows of up to CHUNK queries, of one segment or several, with the k-th score of each within its own segment."""
    def chunk(held: list[tuple[int, int, list[int]]], floors: list[int], dim: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([_packed(held, dim) | {"floors": np.array(floors, "<i8").tobytes()}], _CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, floors, dim = [], [], None
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows, whole = _unpack(row)
                asked = np.flatnonzero((ids != NO_ID) & (ids % every == 0))
                vectors, queries = _numbers(whole, whole)
                own = Segment(ids, rows, vectors)
                for q in asked:
                    if held and (row["dim"] != dim or len(held) == CHUNK):
                        yield chunk(held, floors, dim)
                        held, floors = [], []
                    dim = row["dim"]
                    found = own.search(queries[q], int(rows[q]), k, NONE)
                    held.append((int(ids[q]), int(rows[q]), whole[q].tolist()))
                    floors.append(found[-1][0] if len(found) == k else NONE)
        if held:
            yield chunk(held, floors, dim)

    return segments.mapInArrow(run, "dim int, ids binary, rows binary, vectors binary, floors binary")


def _hits(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in batch.to_pylist():
            ids, rows, whole = _unpack({"dim": pair["dim"], "ids": pair["q_ids"], "rows": pair["q_rows"], "vectors": pair["q_vectors"]})
            s_ids, s_rows, s_whole = _unpack(pair)
            vectors, queries = _numbers(s_whole, whole)
            segment, out = Segment(s_ids, s_rows, vectors), []
            for i, floor in enumerate(np.frombuffer(pair["floors"], "<i8").tolist()):
                for score, other, row in segment.search(queries[i], int(rows[i]), k, floor):
                    out.append({"query_row": int(rows[i]), "query_id": int(ids[i]),
                                "vec_id": None if other == NO_ID else other, "row": row, "score": score})
            yield pa.RecordBatch.from_pylist(out, _HIT)


def _buckets(segments: int, partitions: int) -> int:
    """How many buckets the segments are dealt to; each gets its copy of the queries, so there are no more than tasks ask for."""
    return max(1, min(segments // 4, COPIES * partitions))


def top_k(table: DataFrame, k: int = 5, every: int = 50, scale: int = 256, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for each row whose id is divisible by ``every``.

    Candidates are all rows but the query's own, also those that repeat its id,
    with a vector of the same length; rows with a null id are candidates only,
    and rank behind others of their score.  Vectors that are null or hold a
    null or non-finite component take no part.  Scores must fit a long.
    """
    rows, row = identified(table.select(F.col(vec_id).cast("long").alias("id"), quantized(F.col(vector), scale).alias("vector")
                                        ).where("vector is not null"), "vectors")
    spark = table.sparkSession
    blocks = materialize(segments(rows.withColumnRenamed(row, "row")), "segments")
    buckets = _buckets(blocks.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = materialize(_chunks(blocks, k, every), "queries")
    asked = asked.select("dim", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("vectors").alias("q_vectors"),
                         "floors", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    # Spark takes the copies for as small as the written queries and would broadcast them through the driver
    pairs = blocks.withColumn("bucket", F.pmod(F.xxhash64("rows"), F.lit(buckets)).cast("int")).join(
        asked.hint("merge"), ["bucket", "dim"])
    hits = pairs.select("dim", "q_ids", "q_rows", "q_vectors", "floors", "ids", "rows", "vectors").mapInArrow(
        lambda batches: _hits(batches, k), "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
