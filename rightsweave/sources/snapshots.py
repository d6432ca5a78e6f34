"""Snapshot tables: a write counts once its manifest is in place.

A table is a folder with ``data/<snapshot>`` (Parquet, written once, never
changed) and ``manifests/<version>-<snapshot>.json``.  A manifest is written
under a hidden name and renamed to its own, the only step that makes a snapshot
visible, so a reader sees a whole snapshot or an earlier one, and what a job
that was cut off has left is never read.  Names are never shared: writers that
run at the same time cannot damage each other, and of two that took the same
version the one of the greater snapshot id counts.  The folder's file system
must rename files atomically.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .io import write_parquet


class Snapshot(NamedTuple):
    """A written snapshot: its id, number of rows and schema; ``version`` is 0 until it is committed."""

    snapshot: str
    rows: int
    schema: str
    version: int = 0


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _data(root: str, snapshot: str) -> str:
    return f"{root.rstrip('/')}/data/{snapshot}"


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def _names(spark: SparkSession, root: str) -> list[str]:
    """Names of the manifests in place, oldest version first."""
    fs, folder = _file_system(spark, _manifests(root))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def stage(df: DataFrame, root: str, partition_by: str | list[str] | None = None) -> Snapshot:
    """Write the data of a new snapshot; nobody reads it before :func:`commit`."""
    spark, snapshot = df.sparkSession, uuid.uuid4().hex
    write_parquet(df, _data(root, snapshot), partition_by, mode="errorifexists")
    rows = spark.read.schema(df.schema).parquet(_data(root, snapshot)).count()  # from the footers
    return Snapshot(snapshot, rows, df.schema.json())


def commit(spark: SparkSession, root: str, staged: Snapshot) -> Snapshot:
    """Put the manifest of a staged snapshot in place, as the version after the newest one."""
    names = _names(spark, root)
    done = staged._replace(version=int(names[-1].split("-")[0]) + 1 if names else 1)
    name = f"{done.version:012d}-{done.snapshot}.json"
    fs, hidden = _file_system(spark, f"{_manifests(root)}/.{name}")
    out = fs.create(hidden, True)
    out.write(json.dumps(done._asdict()).encode())
    out.close()
    if not fs.rename(hidden, _file_system(spark, f"{_manifests(root)}/{name}")[1]):
        raise RuntimeError(f"manifest {name} of {root} could not be put in place")
    return done


def write(df: DataFrame, root: str, partition_by: str | list[str] | None = None) -> Snapshot:
    """A new snapshot of the table, staged and committed."""
    return commit(df.sparkSession, root, stage(df, root, partition_by))


def newest(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """The newest committed snapshot, or the one of ``version``; None where there is none."""
    names = [n for n in _names(spark, root) if version is None or int(n.split("-")[0]) == version]
    if not names:
        return None
    return Snapshot(**json.loads(spark.read.text(f"{_manifests(root)}/{names[-1]}").head()[0]))


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest committed snapshot, or that of ``version``."""
    found = newest(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"{root} has no committed snapshot" + (f" of version {version}" if version else ""))
    schema = T.StructType.fromJson(json.loads(found.schema))
    return spark.read.schema(schema).parquet(_data(root, found.snapshot)).select(*(f"`{n}`" for n in schema.names))


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot of a snapshot table, or a plain Parquet folder as it is."""
    return read(spark, path) if _names(spark, path) else spark.read.parquet(path)


def _plain(spark: SparkSession, root: str) -> bool:
    """True for a finished plain Parquet folder."""
    fs, marker = _file_system(spark, f"{root.rstrip('/')}/_SUCCESS")
    return fs.exists(marker)


def read_or_compute(spark: SparkSession, root: str, compute: Callable[[], DataFrame],
                    partition_by: str | list[str] | None = None) -> DataFrame:
    """The newest snapshot; where there is none, ``compute()`` is written first.

    Of jobs that find nothing at the same time each writes a whole snapshot
    and all later reads agree on one.  Errors in ``compute`` propagate and
    leave the table as it was.  A finished plain Parquet folder is read as it is.
    """
    if newest(spark, root) is None:
        if _plain(spark, root):
            return spark.read.parquet(root)
        write(compute(), root, partition_by)
    return read(spark, root)
