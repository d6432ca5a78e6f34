"""SimHash near-dedup by multi-index hashing.

Word shingles vote on the 64 bits of a fingerprint.  Distinct fingerprints are
cut into segments, and by the pigeonhole principle two of them within the
maximum distance agree up to a small radius in at least one segment.  A table
per segment holds every fingerprint under its segment value; each fingerprint
looks up the small Hamming ball around its own value, and the whole distance
of every match is verified.  Segment values that many fingerprints share are
not looked up: those fingerprints, and all that probe them, meet under the
whole-fingerprint balls of half the distance instead, where a bucket cannot
grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import hex16, identified, ship
from .components import connected_components

BITS = 64
SEED = 42
#: A-Z to a-z on UTF-8 bytes; every other byte stays.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLOCK = 1 << 16


def fingerprint_of(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint: bit i is 1 if set in over half of the shingles' XXH64 (seed 42).

    Null, empty and blank texts have no shingle and get 0; a text with fewer
    words than a shingle is one shingle.
    """
    words = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    joined = b" ".join(words)
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:len(words) - width]))
    stops = ends[width - 1:] - 1
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _BLOCK].tolist(),
                                                            stops[at:at + _BLOCK].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """The key columns and ``fp`` of every row of ``docs``."""
    ship(docs.sparkSession)
    kept = docs.select(*keys, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fp = pa.array((fingerprint_of(t.as_py(), shingle) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], [*keys, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, fp bigint")


def ball(width: int, radius: int) -> list[int]:
    """XOR masks of every change of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _around(value: Column, masks: list[int]) -> Column:
    return F.explode(F.transform(F.array(*(F.lit(_signed(m)).cast("long") for m in masks)),
                                 lambda m: value.bitwiseXOR(m)))


def _segments(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment that is looked up: radii add up to distance + 1 - segments."""
    base, more = divmod(distance + 1 - segments, segments) if distance + 1 >= segments else (0, 0)
    cuts = [BITS * i // segments for i in range(segments + 1)]
    radii = [base + (i < more) for i in range(segments)]
    looked = segments if distance + 1 >= segments else distance + 1
    return [(cuts[i], cuts[i + 1] - cuts[i], radii[i]) for i in range(looked)]


def hamming_links(fps: DataFrame, distance: int = 2, segments: int = 2, bucket: int = 64) -> DataFrame:
    """Pairs (src, dst) of distinct fingerprints ``fp`` at most ``distance`` bits apart, enough for all components.

    Table buckets of up to ``bucket`` fingerprints yield every link through
    them.  Larger ones go the exact whole-fingerprint way of the module's
    docstring, which links each member of a ball to the ball's smallest one.
    """
    def value(shift: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(_signed((1 << width) - 1)))

    looked = _segments(distance, segments)
    entries = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(i).cast("byte").alias("seg"), value(s, w).alias("val"))
        for i, (s, w, _) in enumerate(looked)))).alias("e")).select("e.seg", "e.val", "fp")
    probes = None
    for i, (s, w, r) in enumerate(looked):
        part = fps.select(F.lit(i).cast("byte").alias("seg"), _around(value(s, w), ball(w, r)).alias("val"),
                          F.col("fp").alias("probe"))
        probes = part if probes is None else probes.unionByName(part)
    crowded = materialize(entries.groupBy("seg", "val").count().where(F.col("count") > bucket).select("seg", "val"),
                          "crowded")
    sparse, near = entries, None
    if not crowded.isEmpty():
        sparse = entries.join(crowded, ["seg", "val"], "left_anti")
        touched = probes.join(crowded, ["seg", "val"], "left_semi").select(F.col("probe").alias("fp")).distinct()
        near = _ball_links(materialize(touched, "touched"), distance)
    links = (probes.join(sparse, ["seg", "val"])
             .where((F.col("probe") != F.col("fp")) & (F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= distance))
             .select(F.col("probe").alias("src"), F.col("fp").alias("dst")))
    return links if near is None else links.unionByName(near)


def _ball_links(fps: DataFrame, distance: int) -> DataFrame:
    """Fingerprints within ``distance`` share a value that one reaches with half of it and the other with the rest.

    The members that reach a value with the smaller half lie within
    ``distance`` of each other and of every other member, so that links to
    their smallest one join the whole bucket.
    """
    half, rest = distance // 2, distance - distance // 2
    inner = ball(BITS, half)
    members = fps.select("fp", _around(F.col("fp"), ball(BITS, rest)).alias("val"))
    if rest == half:
        centre = members.groupBy("val").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1")
    else:
        centre = (fps.select("fp", _around(F.col("fp"), inner).alias("val"))
                  .groupBy("val").agg(F.min("fp").alias("low")))
    return members.join(centre, "val").where("fp != low").select(F.col("fp").alias("src"), F.col("low").alias("dst"))


def simhash_groups(docs: DataFrame, keys: list[str], doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   distance: int = 2) -> DataFrame:
    """Key columns, ``fp``, ``root`` and ``group`` of every row: rows whose fingerprints are joined by links share a root.

    ``keys`` must hold ``doc_id``.  ``root`` is the smallest fingerprint of the
    group and ``group`` its smallest doc_id (null if all are null; an id that
    is repeated may be that of two groups).  Every row is kept, repeated rows included;
    an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, keys, text, shingle), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min(doc_id).alias("first")), "distinct")
    roots = connected_components(hamming_links(fps.select("fp"), distance))
    linked = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("group"))
    groups = linked.join(smallest, "root").select("fp", "root", "group")
    return rows.join(groups, "fp").select(*keys, "fp", "root", "group")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of documents; other columns are ignored."""
    return simhash_groups(docs, ["doc_id"], shingle=shingle, distance=distance).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), F.col("group").alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents, columns as they were, with one row left of every near-duplicate group: the smallest doc_id's.

    Rows with a null doc_id come last; among rows with the same doc_id one is
    kept.  Rows without a word all have fingerprint 0 and are one group.
    """
    rows, row = identified(docs)
    groups = simhash_groups(rows, ["doc_id", row], shingle=shingle, distance=distance)
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("best"))
    return rows.join(best.select(F.col(f"best.{row}").alias(row)), row, "left_semi").drop(row)
