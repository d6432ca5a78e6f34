"""Best-fit packing of documents into fixed-size token sequences.

Documents become token ids by a public tokenizer; only those longer than a
sequence are cut.  Pieces are dealt by hash to packing tasks and placed there
by bounded-space online best-fit: a fixed number of open bins is kept in a
bitset keyed by free space, a piece goes to the open bin that it fills best,
and when a new bin is needed while all are open the fullest closes first.  The
pieces of a task arrive longest first, which leaves little space unused.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship

class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, by a byte-level BPE file of the tokenizers library.

    The file's vocabulary and merges are run by tiktoken, which gives the ids
    that tokenizers gives at a quarter of its time (the tests compare them).
    Texts with one of the file's special strings, and any that tiktoken
    refuses, go through tokenizers itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        printed = _printed_bytes()
        ranks = {bytes(printed[c] for c in token): i
                 for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if i not in added}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            try:
                return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
            except ValueError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _printed_bytes() -> dict[str, int]:
    """The byte that each printed character of a byte-level vocabulary stands for.

    Bytes with a visible Latin-1 character stand for themselves; the others
    take the characters from 256 on, in order.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: a text within the capacity whole, else a shorter first piece and full ones."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, keys: list[str], tokenizer: str, capacity: int = 1024, end_id: int = 2,
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """Key columns, piece, start, length, ids_crc32 and (``with_ids``) the ids as binary, per piece of each row.

    A null text counts as empty: its only id is ``end_id``.  Repeated rows are
    documents of their own.
    """
    ship(docs.sparkSession)
    kept = docs.select(*keys, F.col(text).cast("string").alias("__text"))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column(batch.num_columns - 1)):
                data = encode(t.as_py() or "") + end
                for k, (at, n) in enumerate(cuts(len(data) // 4, capacity)):
                    own = data[4 * at:4 * (at + n)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
            own_keys = [c.take(pa.array(row, pa.int32())) for c in batch.columns[:-1]]
            made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64())] + ([pa.array(ids, pa.binary())] if with_ids else [])
            names = [*keys, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            yield pa.RecordBatch.from_arrays([*own_keys, *made], names)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + "piece int, start bigint, length bigint, ids_crc32 bigint"
                           + (", ids binary" if with_ids else ""))


class Bins:
    """Bounded-space best-fit: at most ``most`` open bins of ``capacity``, in a bitset keyed by free space."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most = capacity, most
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = self.open = self.made = 0

    def _pop(self, free: int) -> int:
        bins = self.free[free]
        found = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin's number and the offset of a piece in it."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._pop(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
            if self.open >= self.most and length < free:
                self._pop((self.mask & -self.mask).bit_length() - 1)
        left = free - length
        if left:
            self.free[left].append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(parts: DataFrame, capacity: int = 1024, open_bins: int = 1 << 16, per_task: int = 1 << 17) -> DataFrame:
    """``parts`` (of ``pieces``) with sequence_id and offset.

    About ``per_task`` pieces meet in a packing task, dealt by a hash of all
    their columns, so that no group of equal keys meets in one task.  Sequence
    ids are unique over all tasks; offsets leave no gap.  An empty table gives
    an empty result.
    """
    parts = materialize(parts, "pieces")
    tasks = max(1, -(-parts.count() // per_task))
    names = parts.columns
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = Bins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    ordered = [F.col(c) for c in names if c not in ("length", "ids")]
    return (parts.repartition(tasks, F.xxhash64(*(c for c in names if c != "ids")))
            .sortWithinPartitions(F.desc("length"), *ordered)
            .mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, open_bins: int = 1 << 16,
                   with_ids: bool = False) -> DataFrame:
    """Every piece of the documents (doc_id, text) with its sequence and offset; other columns are ignored."""
    return pack(pieces(docs, ["doc_id"], tokenizer, capacity, end_id, with_ids=with_ids), capacity, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary) and doc_ids of each full sequence; ``packed`` must hold the ids."""
    return (packed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
            .select("sequence_id", F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> a || x)").alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))
