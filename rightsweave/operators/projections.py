"""Renaming projections, done in one ``select`` (no chain of withColumnRenamed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def suffix_columns(df: DataFrame, suffix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Append ``_suffix`` to every column except those in ``keep``."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(f"{c}_{suffix}") for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Prepend ``prefix_`` to every column."""
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])
