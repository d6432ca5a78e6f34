"""Session construction and shared-folder helpers.

Lineage is cut by writing Parquet into the folder named by
``spark.checkpoint.dir`` (a shared file system on a cluster).  A folder is
only invented when the setting is missing *and* driver and executors are one
process, as in tests; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}
#: Settings of a session that this library starts itself (tests, benchmarks, local runs).
_LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "rightsweave") -> SparkSession:
    """A session on ``master`` with local settings, or the submitted one as it is.

    Without a ``master`` every setting comes from spark-submit; only the
    session time zone is set to UTC where nothing was submitted, as dates
    would otherwise depend on the machine.
    """
    if master is None:
        spark = SparkSession.builder.getOrCreate()
        if not spark.sparkContext.getConf().contains("spark.sql.session.timeZone"):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return spark
    spark = SparkSession.builder.appName(app_name).master(master).config(map={
        **_LOCAL_SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("RW_DRIVER_MEMORY", "16g")}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Taken from ``spark.checkpoint.dir``, which must name storage that the
    driver and all executors share; in a single-process local session without
    that setting a fresh folder under the system temp dir is created once per
    process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if master not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[master] = tempfile.mkdtemp(prefix="rightsweave-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK[master])
    return _LOCAL_FALLBACK[master]


def run_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{scratch_dir(spark)}/rightsweave/{spark.sparkContext.applicationId}"


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialised folders that no frame still to be computed reads."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard_intermediates(spark: SparkSession) -> None:
    """Delete what this application has materialised; for a job whose results are written."""
    discard(spark, [run_dir(spark)])


_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """Collects the folders that :func:`materialize` writes inside the block, for a later :func:`discard`."""
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield paths
    finally:
        _WRITTEN.reset(token)
        if (outer := _WRITTEN.get()) is not None:
            outer.extend(paths)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside the block go when it is written, not when the driver collects garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    every earlier level) and gives AQE exact sizes for the next join.  The
    shuffle files of the write are not needed any more and are deleted.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{uuid.uuid4().hex}/{name}"
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer-inference job


def materialize_alone(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """What ``make`` returns, written; what was materialised for it, and is read by nothing else, is deleted."""
    with tracked() as paths:
        df = make()
    out = materialize(df, name)
    discard(spark, paths)
    return out


def discard_unread(written: DataFrame, paths: list[str]) -> None:
    """Delete the folders that ``written``, a frame that only reads written rows, does not read."""
    read = written.inputFiles()
    discard(written.sparkSession, [p for p in paths if not any(f"/{uuid_of(p)}/" in f for f in read)])


def uuid_of(path: str) -> str:
    """The folder name that tells a materialised frame from all others."""
    return path.rsplit("/", 2)[1]
