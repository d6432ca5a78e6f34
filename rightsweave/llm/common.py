"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a session, once per application."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    application = spark.sparkContext.applicationId
    if application in _SHIPPED or not os.path.isdir(package):
        return
    top, name = os.path.split(package)
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", top, name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until it clashes with no column in ``taken`` (case is ignored, as Spark does)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def identified(df: DataFrame, name: str = "rows") -> tuple[DataFrame, str]:
    """``df`` written once with a unique long per row, and that column's name.

    The ids are unique and, being written, the same for every later reader,
    also after an executor is lost.
    """
    row = fresh(df.columns, "_row")
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), name), row


def hex16(c: Column) -> Column:
    """A long as 16 lowercase hex digits (two's complement)."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))
