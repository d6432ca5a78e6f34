"""URL filters: longest-match host and path rules, and gradient-boosted trees on lexical features for the rest.

Everything is a DataFrame expression or a Spark ML estimator; the trees are
trained on the URLs that a rule decides.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: (verdict, rule): a host, then the beginning of a path.
Rules = list[tuple[str, str]]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; of equally long ones the longer host's.

    A rule fits its host and all subdomains, for paths that start with its own.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].find("/"), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: n - F.length(F.replace(text, c, F.lit(""))))
    total = F.aggregate(counts, F.lit(0.0), lambda a, k: a + F.when(k > 0, -k / n * F.log2(k / n)).otherwise(0.0))
    return F.when(n > 0, total).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Length, depth, digit, entropy and parameter features of a URL without nulls."""
    size = F.length(url).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = size - F.length(F.translate(url, "0123456789", ""))
    return {
        "url_length": size, "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"), "labels": F.when(host != "", _count(host, ".") + 1).otherwise(0.0),
        "hyphens": _count(host, "-"), "digit_ratio": F.when(size > 0, digits / size).otherwise(0.0),
        "entropy": _entropy(url), "host_entropy": _entropy(host),
        "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0.0),
        "secure": url.startswith("https://").cast("double"),
    }


def judge(pages: DataFrame, keys: list[str], rules: Rules, url: str = "url", sample: int = 20_000, trees: int = 20,
          depth: int = 4) -> DataFrame:
    """Key columns, host, path, rule, verdict and block_score of every row.

    Where a rule fits, its verdict stands.  The others are blocked where the
    trees' probability is at least a half; it is trained on at most about
    ``sample`` URLs that a rule decides, chosen by a hash of the URL, with the
    lexical features and, for the host's last label and last two, how many of
    all rows share them.  If the rules decide no URL, the rest is allowed; if
    they decide all alike, the rest is judged the same.  Null URLs count as
    empty, and repeated rows as rows of their own.
    """
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(*keys, text.alias("__url")).withColumn("host", host_of(F.col("__url"))).withColumn(
        "path", path_of(F.col("__url"))).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    names = lexical(F.col("__url"), F.col("host"), F.col("path"))
    rows = rows.withColumn("last", F.substring_index("host", ".", -1)).withColumn("last_two", F.substring_index("host", ".", -2))
    rows = materialize(rows.select(*keys, "host", "path", "found", "last", "last_two", F.xxhash64("__url").alias("__hash"),
                                   *(c.alias(n) for n, c in names.items())), "urls")
    for suffix in ("last", "last_two"):
        counts = materialize(rows.groupBy(suffix).agg(F.log1p(F.count("*")).alias(f"{suffix}_rows")), suffix)
        rows = rows.join(counts, suffix)
    inputs = [*names, "last_rows", "last_two_rows"]
    known = rows.where("found is not null")
    kinds = {r["verdict"]: r["count"] for r in known.groupBy("found.verdict").count().collect()}
    if len(kinds) < 2:
        score = rows.withColumn("block_score", F.lit(1.0 if "block" in kinds else 0.0))
    else:
        share = min(1.0, sample / sum(kinds.values()))
        chosen = known.where(F.pmod("__hash", F.lit(1_000_000)) < int(share * 1_000_000))
        vectors = VectorAssembler(inputCols=inputs, outputCol="__features")
        fit = chosen.select(*inputs, F.col("found.verdict").eqNullSafe("block").cast("double").alias("__label"))
        trainer = (GBTClassifier(featuresCol="__features", labelCol="__label", predictionCol="__prediction",
                                 maxIter=trees, maxDepth=depth, seed=1)
                   .setRawPredictionCol("__raw").setProbabilityCol("__probability"))
        model = trainer.fit(vectors.transform(materialize(fit, "labelled")))
        score = model.transform(vectors.transform(rows)).withColumn(
            "block_score", vector_to_array("__probability")[1])
    verdict = F.coalesce("found.verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return score.select(*keys, "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "block_score")
