"""Exact dedup by a content sort.

Texts lose their ASCII white space and are sorted by their bytes: splitters that
Spark samples range-partition the rows, the external sort within a partition
puts equal texts next to each other, and neighbours are compared in full.  The
splitters are bounded whatever the texts are: the first bytes of a text, a
digest that parts texts with equal beginnings, and the rank within a group, so
that a group of any size spreads over several partitions.  Groups that may go on in the
next partition leave one row a partition, and those rows are grouped by their
whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh, ship

#: What a normalised text lacks.
_BLANK = b" \t\n\v\f\r"
#: Bytes of a text in a splitter.
HEAD = 64
#: Rows of a group that a task holds at most before it lets them go and gives the group's size later.
HELD = 1 << 14
#: Rows of an output batch.
_ROWS = 1 << 13


def _normalised(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """Columns c0, c1, … (carried), length, no_id, doc_id, row, head, digest and body of every row."""
    kept = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)),
                       F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("length"),
                       F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.monotonically_increasing_id().alias("row"),
                       F.col(text).cast("string").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [(b.as_py() or b"").translate(None, _BLANK) for b in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([b[:HEAD] for b in bodies], pa.binary()),
                 pa.array([xxhash.xxh3_128_digest(b) for b in bodies], pa.binary()), pa.array(bodies, pa.binary())],
                [*batch.schema.names[:-1], "head", "digest", "body"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + ", head binary, digest binary, body binary")


class _Run:
    """A stretch of equal neighbours within a partition; its first row is the one that ranks first."""

    def __init__(self, number: int, body: bytes, length: int, doc_id: int | None) -> None:
        self.number, self.body, self.length, self.doc_id = number, body, length, doc_id
        self.sha = hashlib.sha256(body).hexdigest()
        self.n = 0
        self.rows: list[pa.RecordBatch] = []  # of carried columns, not given out yet
        self.waiting = 0
        self.let_go = False


def _neighbours(batches: Iterator[pa.RecordBatch], carried: int, schema: pa.Schema, first_number: int) -> Iterator[pa.RecordBatch]:
    """Every row with its group, or with the number of its run if that may go on elsewhere, and a row for each such run."""
    out: list[pa.RecordBatch] = []
    nothing = [pa.nulls(1, schema.field(i).type) for i in range(carried)]

    def give(run: _Run, whole: bool) -> None:
        """Rows that wait, as a whole group or as members of a run."""
        rows = [r for r in run.rows if r.num_rows]
        for i, rest in enumerate(rows):
            n = rest.num_rows
            lead = not i and run.waiting == run.n  # the first row of the run is among them
            out.append(pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([run.number] * n, pa.int64()), pa.array([lead and not k for k in range(n)], pa.bool_()),
                 pa.array([run.n if whole else None] * n, pa.int64()), pa.array([run.doc_id if whole else None] * n, pa.int64()),
                 pa.array([run.sha if whole else None] * n, pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
                schema=schema))
        run.rows, run.waiting = [], 0

    def close(runs: list[_Run], edge: bool) -> None:
        for run in runs:
            whole = not edge and not run.let_go
            give(run, whole)
            if not whole:
                out.append(pa.RecordBatch.from_arrays(
                    [*nothing, pa.array([run.number], pa.int64()), pa.nulls(1, pa.bool_()), pa.array([run.n], pa.int64()),
                     pa.array([run.doc_id], pa.int64()), pa.array([run.sha]), pa.array([run.body], pa.binary()),
                     pa.array([run.length], pa.int64())], schema=schema))

    def full(least: int) -> Iterator[pa.RecordBatch]:
        if out and sum(b.num_rows for b in out) >= least:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out.clear()

    runs: list[_Run] = []  # those of the present key; more than one only if digests collide
    key, number, at_start = None, first_number, True
    for batch in batches:
        column = {name: batch.column(batch.schema.get_field_index(name)) for name in ("length", "doc_id", "head", "digest", "body")}
        rows = pa.RecordBatch.from_arrays(batch.columns[:carried], batch.schema.names[:carried])
        begun = 0
        for i in range(batch.num_rows):
            body = column["body"][i].as_py()
            if runs and body == runs[-1].body:
                continue
            if runs:
                _add(runs[-1], rows, begun, i)
            now = (column["head"][i].as_py(), column["digest"][i].as_py())
            if now != key:
                close(runs, at_start)
                at_start, runs = not runs, []
                key = now
            runs.append(_Run(number, body, column["length"][i].as_py(), column["doc_id"][i].as_py()))
            number, begun = number + 1, i
        if runs:
            _add(runs[-1], rows, begun, batch.num_rows)
            if runs[-1].waiting >= HELD:
                give(runs[-1], False)
                runs[-1].let_go = True
        yield from full(_ROWS)
    close(runs, True)
    yield from full(1)


def _add(run: _Run, rows: pa.RecordBatch, start: int, stop: int) -> None:
    run.rows.append(rows.slice(start, stop - start))
    run.n += stop - start
    run.waiting += stop - start


def exact_groups(docs: DataFrame, carry: tuple[str, ...] | list[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with keep_id, group_size, kept and text_sha256.

    Rows are a group if their texts are identical without ASCII white space; a
    null text counts as empty.  The row with the most code points in its original
    text stays, then the smallest doc_id, null ids last, then any one of rows
    that repeat an id (``kept`` is true once a group).  The digest is of the normalised text
    in UTF-8.  Result names that clash with a carried column get an underscore.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    carry = list(carry)
    sorted_rows = _normalised(docs, carry, text)
    rank = [F.desc("length"), "no_id", "doc_id", "row"]
    sorted_rows = sorted_rows.repartitionByRange("head", "digest", *rank).sortWithinPartitions("head", "digest", "body", *rank)
    kept = [f"c{i}" for i in range(len(carry))]
    names = [*kept, "run", "lead", "size", "keep", "sha", "body", "length"]
    kinds = ", ".join(f"{c} {sorted_rows.schema[c].dataType.simpleString()}" for c in kept)
    ddl = (f"{kinds}, " if kept else "") + "run bigint, lead boolean, size bigint, keep bigint, sha string, body binary, length bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([*(first.schema.field(c) for c in kept), pa.field("run", pa.int64()), pa.field("lead", pa.bool_()),
                            pa.field("size", pa.int64()), pa.field("keep", pa.int64()), pa.field("sha", pa.string()),
                            pa.field("body", pa.binary()), pa.field("length", pa.int64())])
        assert schema.names == names

        def all_of() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from _neighbours(all_of(), len(kept), schema, TaskContext.get().partitionId() << 40)

    found = materialize(sorted_rows.mapInArrow(run, ddl), "runs")
    # one row for each run that reaches a partition's end or was let go: few, and equal ones are met by their whole texts
    runs = found.where("lead is null").select("run", "size", "keep", "sha", "body", "length")
    best = F.min(F.struct((-F.col("length")).alias("length"), F.col("keep").isNull().alias("no_id"), "keep", "run"))
    groups = runs.groupBy("body").agg(best.alias("best"), F.sum("size").alias("all"))
    joined = runs.join(groups, "body").select("run", F.col("best.keep").alias("g_keep"), (F.col("run") == F.col("best.run")).alias("g_lead"),
                                              F.col("all").alias("g_size"), F.col("sha").alias("g_sha"))
    members = found.where("lead is not null")
    whole = members.where("size is not null").select(*kept, F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
                                                     F.col("lead").alias("kept"), F.col("sha").alias("text_sha256"))
    parts = members.where("size is null").select(*kept, "run", "lead").join(joined, "run").select(
        *kept, F.col("g_keep").alias("keep_id"), F.col("g_size").alias("group_size"), (F.col("lead") & F.col("g_lead")).alias("kept"),
        F.col("g_sha").alias("text_sha256"))
    result = ["keep_id", "group_size", "kept", "text_sha256"]
    return whole.unionByName(parts).toDF(*carry, *(fresh(carry, c) for c in result))


def drop_exact_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each group of equal texts, columns as they were; the one that ``exact_groups`` keeps."""
    whole = exact_groups(docs, docs.columns, text)
    return whole.where(F.col(whole.columns[-2])).select(*(F.col(f"`{c}`") for c in docs.columns))
