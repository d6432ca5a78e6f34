"""Registered queries of the operators: thin digests of what each operator returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact, mixing, negatives, packing, runs, simhash, substrings, topk, toxicity, urls, vectors, warc
from .common import table
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.size("draws")).alias("taken"), F.size("draws").alias("copies"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_units(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


#: Looks like the template's own marks.
TRICKY = r"\### Assistant: </turn> ok"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], turns.schema)
    return chat.format_conversations(turns.unionByName(more))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def responses(pages: DataFrame) -> DataFrame:
    """The pages as WARC responses of a crawl, with an HTTP message around the HTML."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("\r\n\r\n"))
    name = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url"))
    uuid = F.concat_ws("-", *(F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return pages.select("page_id", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("date"),
                        F.create_map(F.lit("WARC-IP-Address"), F.lit("192.0.2.1")).alias("headers"),
                        F.encode(F.concat(head, F.coalesce("html", F.lit(""))), "UTF-8").alias("block"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(responses(table(spark, sf_dir, "pages")), ["page_id"])
    return made.select("page_id", "type", "record_id", "refers_to", "target_uri", "payload_digest", "block_digest", "length",
                       F.octet_length("record").alias("record_length"), F.sha2("record", 256).alias("record_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the URL query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), ["page_id"], URL_RULES)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_substrings": op2_substrings,
    "op3_topk": op3_topk,
    "op4_chat": op4_chat,
    "op5_packing": op5_packing,
    "op6_vectors": op6_vectors,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_urls": op9_urls,
    "op10_simhash": op10_simhash,
    "op11_exact": op11_exact,
    "op12_negatives": op12_negatives,
    "op13_runs": op13_runs,
}

__all__ = ["ORACLE", "QUERIES"]
