"""Substring dedup by hashing lines and the sentences in them.

A text is tiled into units: sentences (up to a run of . ! ? before white
space) and line ends.  Units of enough words are normalised (lower case, white
space runs as one space) and hashed; digests are grouped over all documents
with partial aggregation, so that a line that every document holds is counted
where it is read.  The earliest occurrence of a repeated unit stays: the one
with the smallest doc_id, then row, then place.  All others are removed, with
their places in the original text kept.

What is cut from texts (``remove_repeats``) are pieces: the units, and with
them whole short lines, short sentences joined to their neighbours,
sentences of scripts without spaces, and parts of long sentences between
boundaries that the words around them decide.  Pieces may overlap; a removed piece's
characters all stand at an earlier place, so that one copy always stays.
``repeated_units`` lists the units alone, as its SQL does.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh, identified, ship

#: A sentence or the rest of a line, with the white space after it.  Tiles cover the text without a gap.
TILE = r"(?:[^\n.!?]+|[.!?]+[^ \t\n\v\f\r.!?])*[.!?]*[ \t\n\v\f\r]*"
_TILE = re.compile(TILE)
#: Other ASCII white space as spaces.
_SPACES = str.maketrans("\t\n\v\f\r", "     ")
_BLANK = " \t\n\v\f\r"
#: Ends of sentences that no white space follows, and what they end.
_WIDE_STOP = re.compile("[。！？｡।॥۔။។]")
_WIDE = re.compile("[^。！？｡।॥۔။។]*[。！？｡।॥۔။។]+[」』）”’\"')]*[ \t\n\v\f\r]*|[^。！？｡।॥۔။។]+")
#: A character of a script that is written without spaces between words.
_SCRIPTS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_SCRIPTS}]")
#: What boundaries stand between: characters of those scripts and of words longer than LONG_WORD, else words.
_TOKEN = re.compile(f"[{_SCRIPTS}]|[^ \t\n\v\f\r{_SCRIPTS}]+")
LONG_WORD = 64
#: Characters that a part of a sentence has at least.
PART_CHARS = 24
#: Distinct pieces that a task remembers at most.
REMEMBERED = 1 << 17


def units_of(text: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(number, start, stop, digest) of each unit of at least ``min_words`` words; offsets in characters."""
    for number, m in enumerate(_TILE.finditer(text)):
        if m.end() == m.start():
            continue
        words = [w for w in m[0].lower().translate(_SPACES).split(" ") if w]
        if len(words) >= min_words:
            yield number, m.start(), m.end(), hashlib.md5(" ".join(words).encode("utf-8", "replace")).digest()


def _words(piece: str) -> list[str]:
    return [w for w in piece.lower().translate(_SPACES).split(" ") if w]


def _sentences(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, stop, whether a line ends) of each sentence, from the first character that is not white space on."""
    wide = not text.isascii() and _WIDE_STOP.search(text)
    for m in _TILE.finditer(text, len(text) - len(text.lstrip(_BLANK))):
        if m.end() == m.start():
            continue
        parts = [p.span() for p in _WIDE.finditer(text, *m.span())] if wide else [m.span()]
        for start, stop in parts:
            yield start, stop, stop == m.end() and "\n" in m[0]


def _line_spans(line: list[tuple[int, int, int]], min_words: int) -> Iterator[tuple[int, int]]:
    """Spans of the pieces of a line, from (start, stop, size) of its sentences.

    A short sentence goes with what follows and with what precedes it, as far
    as makes it long; a line that is short as a whole is one piece.
    """
    if sum(n for _, _, n in line) < min_words:
        yield line[0][0], line[-1][1]
        return
    for i, (start, stop, n) in enumerate(line):
        if n >= min_words:
            yield start, stop
            continue
        for way in (1, -1):
            j, total = i, n
            while total < min_words and 0 <= j + way < len(line):
                j += way
                total += line[j][2]
            if total >= min_words:
                yield line[min(i, j)][0], line[max(i, j)][1]


def _tokens(piece: str, words: list[str]) -> tuple[list[str], list[int] | None]:
    """The tokens of a sentence in lower case, and where they start if they are not its words."""
    if piece.isascii() and len(max(words, key=len)) <= LONG_WORD:
        return words, None
    low = piece.lower()
    starts = []
    for m in _TOKEN.finditer(piece):
        starts.extend(range(*m.span()) if len(m[0]) > LONG_WORD else [m.start()])
    ends = [*starts[1:], len(piece)]
    return [(low[a:b] if len(low) == len(piece) else piece[a:b].lower()).rstrip(_BLANK) for a, b in zip(starts, ends)], starts


def _boundaries(sentences: list[list[str]], apart: int) -> list[list[int]]:
    """Places in each list of tokens where the hash of the two around is the least within ``apart`` places, and both ends.

    The tokens near a place decide, so that equal runs have equal boundaries
    whatever surrounds them.  Runs of equal hashes are cut in even steps.
    """
    codes, first, gap = [], [], [0] * apart
    for tokens in sentences:
        codes += gap
        first.append(len(codes))
        codes += map(zlib.crc32, " ".join(tokens).encode("utf-8", "replace").split(b" "))
    c = np.array(codes + gap, np.uint64)
    pair = (c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(1)
    inside = np.zeros(len(pair), bool)
    for at, tokens in zip(first, sentences):
        inside[at:at + len(tokens) - 1] = True
    pair[~inside] = np.uint64((1 << 64) - 1)
    for k in range(1, apart + 1):
        inside[k:] &= pair[k:] < pair[:-k]
        inside[:-k] &= pair[:-k] <= pair[k:]
    least, out, step = (np.flatnonzero(inside) + 1).tolist(), [], 8 * apart
    i = 0
    for at, tokens in zip(first, sentences):
        found, n = [0], len(tokens)
        while i < len(least) and least[i] < at + n:
            place = least[i] - at
            found.extend(range(found[-1] + step, place, step))
            found.append(place)
            i += 1
        found.extend(range(found[-1] + step, n, step))
        out.append([*found, n])
    return out


def _parts(text: str, long: list[tuple[int, int, list[str]]], min_words: int) -> Iterator[tuple[int, int, str | None]]:
    """(start, stop, body if known) of the parts of long sentences (start, stop, words).

    A part goes from a boundary over two stretches or more, as far as it has
    twice ``min_words`` tokens and PART_CHARS characters.
    """
    split = [_tokens(text[start:stop], words) for start, stop, words in long]
    for (start, stop, _), (tokens, starts), at in zip(long, split, _boundaries([t for t, _ in split], max(1, min_words - 1))):
        if len(at) < 4:
            continue
        places = starts
        if places is None:
            places = [0, *accumulate(len(w) + 1 for w in tokens)]
            if places.pop() - 1 != len(text[start:stop].rstrip(_BLANK)):  # not single spaces between
                places = [m.start() for m in _TOKEN.finditer(text[start:stop])]
        places.append(stop - start)
        for i, first in enumerate(at[:-2]):
            for last in at[i + 2:]:
                if last - first >= 2 * min_words and places[last] - places[first] >= PART_CHARS:
                    yield start + places[first], start + places[last], None if starts else " ".join(tokens[first:last])
                    break


def pieces_of(text: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(number, start, stop, digest) of each piece by place; white space goes with what precedes it."""
    spans, line, bodies, long = set(), [], {}, []
    for start, stop, ends in _sentences(text):
        piece = text[start:stop]
        words = _words(piece)
        bodies[start, stop] = " ".join(words)
        # in scripts without spaces two characters count as a word
        size = len(words) if piece.isascii() else max(len(words), len(_UNSPACED.findall(piece)) // 2)
        line.append((start, stop, size))
        if words and (size > 2 * min_words or stop - start > LONG_WORD):
            long.append((start, stop, words))
        if ends:
            spans.update(_line_spans(line, min_words))
            line = []
    if line:
        spans.update(_line_spans(line, min_words))
    for start, stop, body in _parts(text, long, min_words) if long else ():
        spans.add((start, stop))
        if body:
            bodies[start, stop] = body
    for number, span in enumerate(sorted(spans)):
        body = bodies.get(span) or " ".join(_words(text[span[0]:span[1]]))
        yield number, *span, hashlib.md5(body.encode("utf-8", "replace")).digest()


def units(docs: DataFrame, keys: list[str], text: str = "text", min_words: int = 5,
          find: Callable[[str, int], Iterator[tuple[int, int, int, bytes]]] = units_of) -> DataFrame:
    """Key columns, unit, start, stop and digest (128 bits) of every unit that ``find`` gives of every row."""
    ship(docs.sparkSession)
    kept = docs.select(*keys, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, t in enumerate(batch.column(batch.num_columns - 1)):
                own = list(find(t.as_py() or "", min_words))
                rows.extend([i] * len(own))
                found.extend(own)
            unit, start, stop, digest = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(rows, pa.int32())) for c in batch.columns[:-1]), pa.array(unit, pa.int32()),
                 pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(digest, pa.binary())],
                [*keys, "unit", "start", "stop", "digest"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + "unit int, start int, stop int, digest binary")


def repeats(docs: DataFrame, row: str, min_words: int = 5,
            find: Callable[[str, int], Iterator[tuple[int, int, int, bytes]]] = pieces_of) -> DataFrame:
    """Every repeated piece that is not the earliest: row, doc_id, unit, start, stop, digest, copies, kept_*.

    ``row`` names a column with a unique long per row of ``docs`` (doc_id,
    text).  Null doc_ids rank last.  Null and blank texts have no piece; an
    empty table gives an empty result.
    """
    found = materialize(units(docs.select(F.col(row).alias("row"), "doc_id", "text"), ["row", "doc_id"],
                              min_words=min_words, find=find), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "unit")
    groups = found.groupBy("digest").agg(F.min(rank).alias("kept"), F.count("*").alias("copies")).where("copies > 1")
    return (found.join(groups, "digest")
            .where("row != kept.row or unit != kept.unit")
            .select("row", "doc_id", "unit", "start", "stop", "digest", "copies", F.col("kept.doc_id").alias("kept_doc_id"),
                    F.col("kept.unit").alias("kept_unit")))


def repeated_units(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """The repeated units of documents (doc_id, text), without the row ids; other columns are ignored."""
    rows, row = identified(docs.select("doc_id", "text"))
    return repeats(rows, row, min_words, units_of).select(
        "doc_id", "unit", "start", "stop", F.lower(F.hex("digest")).alias("digest"), "copies", "kept_doc_id", "kept_unit")


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the spans, which may overlap."""
    if text is None or not spans:
        return text
    kept, at = [], 0
    for start, stop in sorted(spans):
        kept.append(text[at:start])
        at = max(at, stop)
    kept.append(text[at:])
    return "".join(kept)


def _spans(docs: DataFrame, row: str, min_words: int) -> DataFrame:
    """(row, start, stop) of every repeated piece that is not the earliest; one shuffle of a row per piece.

    A task compares its own pieces first, REMEMBERED at a time: what an earlier
    one repeats is gone for certain, and only the earliest of each digest meets those
    of other tasks.  So a digest has at most one row for REMEMBERED pieces,
    however often it stands in the documents.
    """
    ship(docs.sparkSession)
    kept = docs.select(F.col(row).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple] = {}  # by digest: no_id, doc_id, row, unit, start, stop
        gone: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for pieces, keys in ((list(first.values()), list(first)),
                                 (gone, [b"-" + p[2].to_bytes(8, "big") + p[3].to_bytes(8, "big") for p in gone])):
                if pieces:
                    columns = [pa.array(c, t) for c, t in zip(zip(*pieces), _PIECE.types[2:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array([pieces is gone] * len(keys), pa.bool_()), *columns], schema=_PIECE)
            first.clear()
            gone.clear()

        for batch in batches:
            for r, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                r, doc_id = r.as_py(), doc_id.as_py()
                for unit, start, stop, digest in pieces_of(text.as_py() or "", min_words):
                    piece = (doc_id is None, doc_id or 0, r, unit, start, stop)
                    other = first.setdefault(digest, piece)
                    if other is not piece:
                        first[digest] = min(piece, other)
                        gone.append(max(piece, other))
                if len(first) >= REMEMBERED:
                    yield from flush()
        yield from flush()

    found = kept.mapInArrow(run, "digest binary, gone boolean, no_id boolean, doc_id bigint, row bigint, unit int, start int, stop int")
    order = Window.partitionBy("digest").orderBy("no_id", "doc_id", "row", "unit")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("gone") | (F.col("nth") > 1)).select("row", "start", "stop")


_PIECE = pa.schema([("digest", pa.binary()), ("gone", pa.bool_()), ("no_id", pa.bool_()), ("doc_id", pa.int64()), ("row", pa.int64()),
                    ("unit", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])


def remove_repeats(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """The documents, columns as they were, with repeated pieces cut from their texts.

    Every row stays, also one whose text becomes empty; texts without a
    repeated piece, null texts included, are unchanged.
    """
    rows, row = identified(docs)
    spans = fresh(rows.columns, "_spans")
    gone = _spans(rows, row, min_words).groupBy(F.col("row").alias(row)).agg(
        F.collect_list(F.struct("start", "stop")).alias(spans))  # at most the pieces of one row
    joined = rows.join(gone, row, "left").select(*docs.columns, spans)
    names, at = docs.columns, docs.columns.index("text")
    schema = joined.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut(t.as_py(), [(s["start"], s["stop"]) for s in own.as_py() or ()])
                     for t, own in zip(batch.column(at), batch.column(batch.num_columns - 1))]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
