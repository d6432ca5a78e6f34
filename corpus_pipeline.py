"""The corpus pipeline: documents go through five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
to the shared folder and hands what it reads back to the next.

A stage's result is lazy and reads intermediates in the shared folder.  It has
to be written before the next stage is called, as the next one's documents
are what was written: each stage first deletes the intermediates of the stage
called before it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rightsweave.llm import mixing, packing, simhash, substrings, toxicity
from rightsweave.llm.common import identified, table
from rightsweave.session import discard, materialize, tracked

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders that the last stage called has written on its way.
_LEFT: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, after deleting the intermediates of the one before."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _LEFT)
        _LEFT.clear()
        with tracked() as paths:
            out = stage(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out

    return run_stage


@_tidy
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the scorer learns from the labels beside the documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@_tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (shingles of three words, at most two bits apart)."""
    return simhash.drop_near_copies(docs, shingle=3, distance=2)


@_tidy
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated sentences and lines are cut from all documents but the first; n_chars follows the text."""
    cut = substrings.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources draws them, shard by shard."""
    rows, row = identified(docs)
    return mixing.mix(rows, row).select(*docs.columns)


@_tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the drawn documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores and tokenizer ids are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    out = STAGES[-1][1](spark, docs, sf_dir)
    _LEFT.clear()  # the result is still to be read
    return out
