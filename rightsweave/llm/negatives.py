"""Hard negatives by angular triangle filtering.

Every integer vector is stored with the cosine and sine of its angle to some
reference directions, and with its norm.  The angle between two vectors lies
between the difference and the sum of their angles to any reference, so that
the cosine lies between cos(a)cos(b) - sin(a)sin(b) and cos(a)cos(b) + sin(a)sin(b);
times both norms, and widened by far more than doubles can be off, these are bounds of the
score.  Only rows whose interval meets a window that an anchor asks for get an
integer score.

Rows of like vectors are packed into segments, anchors into chunks, each with the
range of its norms and angles.  The same triangles on those ranges choose the
pairs of chunk and segment before any vector travels; a chunk first meets the
segment that promises most, and what it finds there is the least that other segments must reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import identified, ship
from .topk import quantized

#: Rows of a segment, of a block in it, and of a chunk of anchors; numbers that a segment's vectors hold at most.
SEGMENT, BLOCK, CHUNK, NUMBERS = 4096, 256, 256, 1 << 19
#: Reference directions, and rows they are picked from at most (about; by a hash of the row).
REFERENCES, SAMPLE = 16, 4096
#: Summaries that are held against each other at a time, and segments that one task takes for a chunk.
PACK, REACH = 1024, 16
#: A score bound is widened by this share of the product of the norms.
SLACK = 1e-6
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Doubles hold all integers up to here.
EXACT = 1 << 53
#: Stands for a null id, which ranks last.
NO_ID = HIGHEST

References = dict[int, np.ndarray]


def pick_references(vectors: DataFrame, n: int) -> References:
    """Reference directions by dimension: rows of a bounded sample, each far from those before it."""
    share = min(1.0, SAMPLE / max(1, n))
    scale = 1 << 30
    chosen = vectors.where(F.pmod(F.xxhash64("row"), F.lit(scale)) < max(1, int(share * scale))).select("vector").limit(4 * SAMPLE)
    by_dim: dict[int, list[np.ndarray]] = {}
    for (v,) in chosen.collect():
        x = np.array(v, np.float64)
        length = np.sqrt((x / max(1.0, np.abs(x).max(initial=0)) ) @ (x / max(1.0, np.abs(x).max(initial=0))))
        if length:
            by_dim.setdefault(len(x), []).append(x / max(1.0, np.abs(x).max()) / length)
    found = {}
    for dim, rows in by_dim.items():
        unit = np.array(sorted(rows, key=lambda r: r.tolist()))
        picked, nearest = [unit.mean(0)], None
        size = np.sqrt(picked[0] @ picked[0])
        picked[0] = picked[0] / size if size > 1e-3 else unit[0]
        while len(picked) < min(REFERENCES, len(unit)):
            cosine = unit @ picked[-1]
            nearest = cosine if nearest is None else np.maximum(nearest, cosine)
            picked.append(unit[int(np.argmin(nearest))])
        found[dim] = np.array(picked)
    return found


def _against(vectors: np.ndarray, references: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(norms, cosines to each reference) of integer vectors; the zero vector has norm 0 and cosines 0."""
    x = vectors.astype(np.float64)
    most = np.maximum(1.0, np.abs(x).max(1, initial=0))
    x = x / most[:, None]
    size = np.sqrt((x * x).sum(1))
    unit = x / np.where(size > 0, size, 1)[:, None]
    cosines = np.clip(unit @ references.T, -1, 1) if references is not None else np.zeros((len(x), 0))
    return size * most, cosines


def _narrow(vectors: np.ndarray) -> tuple[str, bytes]:
    most = np.abs(vectors.astype(float)).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return kind, vectors.astype(kind).tobytes()


_ROWS = "dim int, number bigint, ids binary, rows binary, labels binary, kind string, vectors binary, norms binary, cosines binary"


def _packed(table: DataFrame, references: References, most: int, offset: int) -> DataFrame:
    """Rows of up to ``most`` vectors (_ROWS) from (id, row, label, vector), like vectors of a label near each other."""
    kept = table.select(F.size("vector").alias("dim"), F.coalesce("id", F.lit(int(NO_ID))).alias("id"), "row",
                        F.col("label").cast("long").alias("label"), "vector")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, close = [], []
            for v in batch.column(4).to_pylist():
                x = np.array([v], np.int64)
                cosines = _against(x, references.get(len(v)))[1][0]
                near.append(int(np.argmax(cosines)) if len(cosines) else -1)
                close.append(float(cosines.max(initial=-1.0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(close, pa.float64())],
                                             [*batch.schema.names, "near", "close"])

    order = ["dim", "label", "near", "close", "row"]
    placed = kept.mapInArrow(place, "dim int, id bigint, row bigint, label bigint, vector array<bigint>, near int, close double")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = offset + (TaskContext.get().partitionId() << 32)
        held: list[tuple] = []
        dim = None

        def row() -> pa.RecordBatch:
            ids, rows, labels, vectors = zip(*held)
            whole = np.array(vectors, np.int64).reshape(len(held), dim)
            norms, cosines = _against(whole, references.get(dim))
            kind, data = _narrow(whole)
            return pa.RecordBatch.from_pylist([{
                "dim": dim, "number": number, "ids": np.array(ids, "<i8").tobytes(), "rows": np.array(rows, "<i8").tobytes(),
                "labels": np.array(labels, "<i8").tobytes(), "kind": kind, "vectors": data,
                "norms": norms.astype("<f8").tobytes(), "cosines": cosines.astype("<f8").tobytes()}], _PACKED)

        for batch in batches:
            for d, *one in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if held and (d != dim or len(held) >= max(1, min(most, NUMBERS // max(1, d)))):
                    yield row()
                    number += 1
                    held = []
                dim = d
                held.append((one[0], one[1], one[2], one[3]))
        if held:
            yield row()

    return placed.mapInArrow(pack, _ROWS)


_PACKED = pa.schema([("dim", pa.int32()), ("number", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("labels", pa.binary()),
                     ("kind", pa.string()), ("vectors", pa.binary()), ("norms", pa.binary()), ("cosines", pa.binary())])


class Pack:
    """The vectors of a segment or chunk."""

    def __init__(self, row: dict) -> None:
        self.ids, self.rows, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "rows", "labels"))
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(n, row["dim"])
        self.norms = np.frombuffer(row["norms"], "<f8")
        self.cosines = np.frombuffer(row["cosines"], "<f8").reshape(n, -1)
        self.sines = np.sqrt(1 - self.cosines * self.cosines)

    def ranges(self, cuts: list[slice]) -> dict[str, np.ndarray]:
        """Smallest and largest angle to each reference, norm and label of each part."""
        angles = np.arccos(self.cosines)
        return {"low": np.array([angles[c].min(0) for c in cuts]), "high": np.array([angles[c].max(0) for c in cuts]),
                "least": np.array([self.norms[c].min() for c in cuts]), "most": np.array([self.norms[c].max() for c in cuts]),
                "first": np.array([self.labels[c].min() for c in cuts]), "last": np.array([self.labels[c].max() for c in cuts])}


def _between(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Safe (lower, upper) bounds of scores between every part of ``a`` and every part of ``b``."""
    apart = np.zeros((len(a["least"]), len(b["least"])))
    widest = np.full_like(apart, np.pi)
    for r in range(a["low"].shape[1]):
        al, ah, bl, bh = a["low"][:, None, r], a["high"][:, None, r], b["low"][None, :, r], b["high"][None, :, r]
        apart = np.maximum(apart, np.maximum(al - bh, bl - ah))
        low, high = al + bl, ah + bh
        widest = np.minimum(widest, np.where((low <= np.pi) & (high >= np.pi), np.pi, np.where(high < np.pi, high, 2 * np.pi - low)))
    most, least = a["most"][:, None] * b["most"][None, :], a["least"][:, None] * b["least"][None, :]
    upper, lower = np.cos(apart), np.cos(np.maximum(widest, apart))
    slack = SLACK * most + SLACK
    return np.where(lower < 0, lower * most, lower * least) - slack, np.where(upper > 0, upper * most, upper * least) + slack


def _labels_fit(a: dict[str, np.ndarray], b: dict[str, np.ndarray], same: bool) -> np.ndarray:
    """Whether labels may be equal (or differ) between the parts."""
    if same:
        return (a["first"][:, None] <= b["last"][None, :]) & (b["first"][None, :] <= a["last"][:, None])
    one = (a["first"] == a["last"])[:, None] & (b["first"] == b["last"])[None, :]
    return ~(one & (a["first"][:, None] == b["first"][None, :]))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact."""
    most = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(vectors.astype(float)).max(initial=0))
    if most * max(1, vectors.shape[1]) < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return (queries.astype(object) @ vectors.astype(object).T).astype(np.int64)


def _whole(bound: np.ndarray) -> np.ndarray:
    """Window bounds as doubles that are compared with score bounds; the slack is far wider than their rounding."""
    return bound.astype(np.float64)


class Asked:
    """A chunk's anchors with their windows, and the k best found in each so far."""

    def __init__(self, row: dict, k: int, same: bool) -> None:
        self.pack, self.k, self.same, self.number = Pack(row), k, same, row["number"]
        n = len(self.pack.ids)
        self.low, self.high, self.floor = (np.frombuffer(row[c], "<i8").reshape(n, -1).copy() for c in ("lows", "highs", "floors"))
        self.floor = np.maximum(self.floor, self.low)
        self.best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}  # (-score, id, row) by anchor and window
        self.ranges = self.pack.ranges([slice(i, i + 1) for i in range(n)])

    def meet(self, segment: Pack) -> None:
        cuts = [slice(a, a + BLOCK) for a in range(0, len(segment.ids), BLOCK)]
        parts = segment.ranges(cuts)
        lower, upper = _between(self.ranges, parts)
        fit = _labels_fit(self.ranges, parts, self.same)
        own = self.pack
        for b in np.argsort(-upper.max(0, initial=-np.inf), kind="stable"):
            floor, high = _whole(self.floor), _whole(self.high)
            asks = fit[:, b] & ((upper[:, b, None] >= floor) & (lower[:, b, None] <= high)).any(1)
            queries = np.flatnonzero(asks)
            if not len(queries):
                continue
            part = cuts[b]
            c = own.cosines[queries, None, :] * segment.cosines[None, part]
            s = own.sines[queries, None, :] * segment.sines[None, part]
            size = own.norms[queries, None] * segment.norms[None, part]
            slack = SLACK * size + SLACK
            up = size * (c + s).min(2, initial=1.0) + slack
            down = size * (c - s).max(2, initial=-1.0) - slack
            labels = own.labels[queries, None] == segment.labels[None, part]
            meets = (labels if self.same else ~labels) & (own.rows[queries, None] != segment.rows[None, part])
            meets &= ((up[:, :, None] >= floor[queries, None, :]) & (down[:, :, None] <= high[queries, None, :])).any(2)
            rows, asking = np.flatnonzero(meets.any(0)), np.flatnonzero(meets.any(1))
            if not len(rows):
                continue
            meets = meets[np.ix_(asking, rows)]
            at = part.start + rows
            scores = _scores(own.vectors[queries[asking]], segment.vectors[at])  # one product for the rows concerned
            for w in range(self.low.shape[1]):
                q = queries[asking]
                hit = meets & (scores >= self.floor[q, w][:, None]) & (scores <= self.high[q, w][:, None])
                for i in np.flatnonzero(hit.any(1)):
                    j = np.flatnonzero(hit[i])
                    self._take(int(q[i]), w, scores[i, j], segment.ids[at[j]], segment.rows[at[j]])

    def _take(self, query: int, window: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        best = self.best.setdefault((query, window), [])
        best.extend(zip((-scores).tolist(), ids.tolist(), rows.tolist()))
        best.sort()
        del best[self.k:]
        if len(best) == self.k:
            self.floor[query, window] = max(int(self.floor[query, window]), -best[-1][0])

    def hits(self) -> list[dict]:
        """What was found, and one row with the floors."""
        out = [{"chunk": self.number, "query": int(self.pack.rows[q]), "query_id": int(self.pack.ids[q]), "window": w, "score": -s,
                "vec_id": None if i == NO_ID else i, "row": r} for (q, w), best in self.best.items() for s, i, r in best]
        return [*out, {"chunk": self.number, "floors": self.floor.astype("<i8").tobytes(),
                       "least": int(np.where(self.low <= self.high, self.floor, HIGHEST).min(initial=HIGHEST))}]


_HIT = pa.schema([("chunk", pa.int64()), ("query", pa.int64()), ("query_id", pa.int64()), ("window", pa.int32()), ("score", pa.int64()),
                  ("vec_id", pa.int64()), ("row", pa.int64()), ("floors", pa.binary()), ("least", pa.int64())])
_HIT_DDL = "chunk bigint, query bigint, query_id bigint, window int, score bigint, vec_id bigint, row bigint, floors binary, least bigint"


def _summaries(packs: DataFrame, name: str) -> DataFrame:
    """Norm, angle and label ranges of every segment or chunk, PACK to a row: (dim, pack, numbers, ranges …)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                pack = Pack(row)
                own = pack.ranges([slice(None)])
                lows = np.frombuffer(row["lows"], "<i8") if "lows" in row else np.array([LOWEST])
                highs = np.frombuffer(row["highs"], "<i8") if "highs" in row else np.array([HIGHEST])
                real = lows <= highs
                out.append({"dim": row["dim"], "number": row["number"],
                            "numbers": [own["least"][0], own["most"][0], *own["low"][0], *own["high"][0]],
                            "first": int(own["first"][0]), "last": int(own["last"][0]),
                            "floor": int(lows[real].min(initial=HIGHEST)), "ceiling": int(highs[real].max(initial=LOWEST))})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("dim", pa.int32()), ("number", pa.int64()), ("numbers", pa.list_(pa.float64())), ("first", pa.int64()),
                ("last", pa.int64()), ("floor", pa.int64()), ("ceiling", pa.int64())]))

    return materialize(packs.mapInArrow(run, "dim int, number bigint, numbers array<double>, first bigint, last bigint, floor bigint, "
                                             "ceiling bigint"), name)


def _ranges_of(summaries: list[dict]) -> dict[str, np.ndarray]:
    numbers = np.array([s["numbers"] for s in summaries], np.float64)
    half = (numbers.shape[1] - 2) // 2
    return {"least": numbers[:, 0], "most": numbers[:, 1], "low": numbers[:, 2:2 + half], "high": numbers[:, 2 + half:],
            "first": np.array([s["first"] for s in summaries]), "last": np.array([s["last"] for s in summaries])}


def chosen_pairs(chunks: DataFrame, segments: DataFrame, same: bool) -> DataFrame:
    """(chunk, segment, upper) of all pairs whose score interval meets a window of the chunk; only summaries travel."""
    def rows(frame: DataFrame, pack: str) -> tuple[DataFrame, int]:
        packs = max(1, -(-frame.count() // PACK))
        one = F.struct("number", "numbers", "first", "last", "floor", "ceiling")
        return frame.groupBy("dim", F.pmod(F.xxhash64("number"), F.lit(packs)).cast("int").alias(pack)).agg(  # about PACK in each
            F.collect_list(one).alias(f"{pack}s")), packs

    asked, _ = rows(_summaries(chunks, "chunk_summaries"), "asked")
    held, packs = rows(_summaries(segments, "segment_summaries"), "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                a, b = _ranges_of(pair["askeds"]), _ranges_of(pair["helds"])
                lower, upper = _between(a, b)
                floor = np.array([s["floor"] for s in pair["askeds"]], np.float64)
                ceiling = np.array([s["ceiling"] for s in pair["askeds"]], np.float64)
                i, j = np.nonzero(_labels_fit(a, b, same) & (upper >= floor[:, None]) & (lower <= ceiling[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pair["askeds"][k]["number"] for k in i], pa.int64()),
                     pa.array([pair["helds"][k]["number"] for k in j], pa.int64()), pa.array(upper[i, j], pa.float64())],
                    ["chunk", "segment", "upper"])

    # the stated anchors against all rows, as pairs of packed summaries of the same dimension, each pair by a key of its own
    asked = asked.withColumn("held", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    return asked.join(held, ["dim", "held"]).select("askeds", "helds").mapInArrow(run, "chunk bigint, segment bigint, upper double")


def _met(chunks: DataFrame, segments: DataFrame, pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """Hits and floors (_HIT) of the pairs (chunk, part, segment, upper): each part of a chunk's segments in one stream."""
    names = [f.name for f in _PACKED] + ["lows", "highs", "floors"]
    first = pairs.select("chunk", "part").distinct().join(chunks.withColumnRenamed("number", "chunk"), "chunk").select(
        "chunk", "part", F.lit(None).cast("double").alias("upper"), *(F.col("chunk" if c == "number" else c).alias(c) for c in names))
    rest = pairs.join(segments.withColumnRenamed("number", "segment"), "segment").select(
        "chunk", "part", "upper", *(F.col("segment" if c == "number" else c).alias(c) for c in names[:-3]),
        *(F.lit(None).cast("binary").alias(c) for c in names[-3:]))
    dealt = first.unionByName(rest).repartition("chunk", "part").sortWithinPartitions(
        "chunk", "part", F.desc_nulls_first("upper"), "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Asked | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["upper"] is None:
                    if now is not None:
                        yield pa.RecordBatch.from_pylist(now.hits(), _HIT)
                    now = Asked(row, k, same)
                else:
                    now.meet(Pack(row))
        if now is not None:
            yield pa.RecordBatch.from_pylist(now.hits(), _HIT)

    return dealt.mapInArrow(run, _HIT_DDL)


def search(chunks: DataFrame, segments: DataFrame, k: int, same: bool) -> DataFrame:
    """chunk, query, query_id, window, rank, vec_id, row and score of the ``k`` best rows in each window of each anchor.

    ``same``: rows of the anchor's label, else of another one.
    """
    pairs = materialize(chosen_pairs(chunks, segments, same), "pairs")
    best = pairs.groupBy("chunk").agg(F.max_by("segment", F.struct("upper", "segment")).alias("segment"))
    first = materialize(_met(chunks, segments, best.select("chunk", "segment", F.lit(0).alias("part"), F.lit(0.0).alias("upper")),
                             k, same), "first_hits")
    floors = first.where("floors is not null").select("chunk", "floors", "least")
    parts = F.pmod(F.xxhash64("segment"), F.greatest(F.lit(1), F.ceil(F.col("n") / REACH))).cast("int")
    left = (pairs.join(best, ["chunk", "segment"], "left_anti").join(floors.select("chunk", "least"), "chunk")
            .where(F.col("upper") >= F.col("least").cast("double")))
    counted = left.groupBy("chunk").agg(F.count("*").alias("n"))
    left = materialize(left.join(counted, "chunk").select("chunk", "segment", parts.alias("part"), "upper"), "left_pairs")
    raised = chunks.drop("floors").join(floors.select(F.col("chunk").alias("number"), "floors"), "number")
    more = _met(raised, segments, left, k, same)
    hits = materialize(first.unionByName(more).where("floors is null").drop("floors", "least"), "hits")
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_windows(chunks: DataFrame, windows: DataFrame | None, k: int, low: int, high: int) -> DataFrame:
    """Chunks with the windows (longs, anchors x windows): all scores, or from each positive's score down to a share of it."""
    names = [f.name for f in _PACKED]
    joined = chunks.withColumn("found", F.lit(None).cast("array<struct<query:bigint,rank:int,score:bigint>>")) if windows is None else (
        chunks.join(windows.groupBy(F.col("chunk").alias("number")).agg(  # at most CHUNK * k
            F.collect_list(F.struct("query", "rank", "score")).alias("found")), "number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found, rows = row.pop("found"), np.frombuffer(row["rows"], "<i8")
                if found is None:
                    lows, highs = np.full((len(rows), 1), LOWEST), np.full((len(rows), 1), HIGHEST)
                else:
                    at = {r: i for i, r in enumerate(rows.tolist())}
                    lows, highs = np.full((len(rows), k), HIGHEST), np.full((len(rows), k), LOWEST)  # nothing
                    for hit in found:
                        i, w, score = at[hit["query"]], hit["rank"] - 1, hit["score"]
                        lows[i, w] = min(HIGHEST, max(LOWEST, -(-low * score // 100)))
                        highs[i, w] = min(HIGHEST, max(LOWEST, high * score // 100))
                out.append(row | {"lows": lows.astype("<i8").tobytes(), "highs": highs.astype("<i8").tobytes(),
                                  "floors": lows.astype("<i8").tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([*_PACKED, *((c, pa.binary()) for c in ("lows", "highs", "floors"))]))

    return joined.select(*names, "found").mapInArrow(run, _ROWS + ", lows binary, highs binary, floors binary")


def hard_negatives(table: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(scale * x); the score is the integer inner product
    of vectors of the same length.  Anchors are rows whose id is divisible by
    ``every``; their positives are the best ``positives`` other rows of their
    label, ties to the smaller id.  For each the best ``negatives`` rows of
    another label follow whose score is between ``low`` and ``high`` percent of
    the positive's.  Rows with a null label, or a vector that is null or holds
    a null or non-finite component, take no part; rows with a null id are no
    anchors and rank behind others of their score.  Repeated ids are rows of their
    own.  Other columns are ignored; an empty table gives an empty result.
    Scores must fit a long.
    """
    ship(table.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    whole = table.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
                         quantized(F.col(vector), scale).alias("vector")).where("vector is not null and label is not null")
    rows, row = identified(whole, "vectors")
    rows = rows.withColumnRenamed(row, "row")
    references = pick_references(rows, rows.count())
    segments = materialize(_packed(rows, references, SEGMENT, 0), "segments")
    chunks = materialize(_packed(rows.where(F.col("id") % every == 0), references, CHUNK, 0), "chunks")
    found = materialize(search(materialize(_with_windows(chunks, None, 1, 0, 0), "asked"), segments, positives, True), "positives")
    asked = materialize(_with_windows(chunks, found, positives, low, high), "asked")
    mined = search(asked, segments, negatives, False).select("query", "window", "rank", F.col("vec_id").alias("negative_id"),
                                                             F.col("score").alias("negative_score"))
    pairs = found.select("query", (F.col("rank") - 1).alias("window"), F.col("query_id").alias("anchor_id"),
                         F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(mined, ["query", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                         "negative_score")
