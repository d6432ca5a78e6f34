"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is cut into blocks by hash.  Its target in words fixes how many
passes over its blocks the mix draws, and where the last pass ends: blocks are
drawn in a permuted order, the block in which the target falls gives only
documents that still fit, and what is left goes on to the blocks after it until
no untaken document of them fits.  The exact block quotas of all sources are then
split among the output shards by a binary tree: at each node the left half's
share of every source is a multivariate-hypergeometric draw, so that shards
get equally many blocks and every source stays exact.  Draws of a source go to
the shards in order, and a shard is shuffled locally.

Everything is a DataFrame expression.  Permutations are arithmetic
(swap-or-not on the block number), so that no source is ever ordered in one
task; running totals go over at most ``STEPS`` sums of a source, then over the
blocks of one such step.  The tables of sources (one row each) are small
beside the documents and are joined with Spark's own choice by size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD

#: Rounds of the block permutation.
ROUNDS = 24
#: Sums of a source's blocks over which its running total goes first.
STEPS = 1024


def _uniform(*key: Column) -> Column:
    """A double in [0, 1) from a hash of the key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Place of ``x`` in a keyed permutation of 0 .. n - 1 (swap-or-not, any n from 1)."""
    def swap(at: Column, other: Column, r: Column) -> Column:
        bit = F.xxhash64(F.greatest(at, other), r, F.lit("bit"), *key).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(at)

    def swap_once(at: Column, r: Column) -> Column:
        return _let(F.pmod(F.pmod(F.xxhash64(r, *key), n) - at, n), lambda other: swap(at, other, r))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap_once)


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series at x + 8, less the logarithm of the eight factors between."""
    def series(x: Column) -> Column:
        y, between = x + 9, x + 1
        for i in range(2, 9):
            between = between * (x + i)
        return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
                - F.log(between))

    return _let(x.cast("double"), series)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` are in ``drawn`` without replacement, by inversion of ``u``.

    The sum starts eight standard deviations below the mean and ends eight
    above it, within the values that are possible.
    """
    def reach(v: Column) -> Column:
        t, g, d = v["t"], v["g"], v["d"]
        mean = F.when(t > 0, d * g / t).otherwise(0.0)
        return _let(mean, lambda m: F.struct(
            m.alias("mean"), F.when(t > 1, 8 * F.sqrt(m * (t - g) / t * (t - d) / (t - 1))).otherwise(0.0).alias("sd8")))

    def bounds(v: Column, r: Column) -> Column:
        low = F.greatest(F.lit(0.0), v["g"] + v["d"] - v["t"], F.floor(r["mean"] - r["sd8"]).cast("double"))
        high = F.least(v["g"], v["d"], F.ceil(r["mean"] + r["sd8"]).cast("double"))
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    def invert(v: Column, b: Column) -> Column:
        t, g, d = v["t"], v["g"], v["d"]

        def step(a: Column, x: Column) -> Column:
            sum_ = a["sum"] + a["p"]
            more = a["p"] * (g - x) * (d - x) / ((x + 1) * (t - g - d + x + 1))
            return F.when(a["done"], a).otherwise(
                F.struct(more.alias("p"), sum_.alias("sum"), x.alias("x"), (sum_ >= u).alias("done")))

        p = F.exp(_log_choose(g, b["low"]) + _log_choose(t - g, d - b["low"]) - _log_choose(t, d))
        start = F.struct(p.alias("p"), F.lit(0.0).alias("sum"), b["low"].alias("x"), F.lit(False).alias("done"))
        return F.when(b["low"] >= b["high"], b["low"]).otherwise(
            F.aggregate(F.sequence(b["low"], b["high"]), start, step, lambda a: a["x"]))

    args = F.struct(total.cast("double").alias("t"), good.cast("double").alias("g"), drawn.cast("double").alias("d"))
    return _let(args, lambda v: _let(reach(v), lambda r: _let(bounds(v, r), lambda b: invert(v, b))))


def targets(sizes: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sizes`` (source, size) with rank, weight and target.

    Sources by code point, null last, take the weights in turn.  All words are
    shared by weight, no target over ``most`` times its source's size; sorted
    by size a weight, the capped sources come first, and the share of one
    weight after them is the level of the rest.  One row per source meets in
    one task.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    by_room = Window.orderBy(F.col("size") / F.col("weight"), "rank")
    rows = sizes.withColumn("rank", rank).withColumn("weight", weight)
    over = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("size").over(Window.partitionBy()) - most * F.coalesce(F.sum("size").over(over), F.lit(0)))
             / F.sum("weight").over(rest))
    capped = F.col("level") * F.col("weight") >= most * F.col("size")
    rows = rows.withColumn("level", level).withColumn("capped", capped)
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(Window.partitionBy())
    return rows.withColumn("target", F.when(F.col("capped"), (most * F.col("size")).cast("double"))
                           .otherwise(F.col("weight") * final)).drop("level", "capped")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, quotas) for every shard from one row with the array ``quotas`` of blocks of each source.

    Each level of the tree halves the shards of every node and draws the left
    half's quotas one source after the other, each given what is left to draw.
    """
    nodes = quotas.select(F.lit(0).alias("first"), F.lit(shards).alias("shards"), "quotas")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        left_shards = (F.col("shards") / 2).cast("int")
        drawn = F.floor(total * left_shards / F.col("shards")).cast("long")

        def draw(a: Column, q: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("first"), F.col("shards"), F.size(a["out"]))
            return _let(hypergeometric(a["total"], q, a["drawn"], u), lambda x: F.struct(
                (a["total"] - q).alias("total"), (a["drawn"] - x).alias("drawn"),
                F.concat(a["out"], F.array(x)).alias("out")))

        start = F.struct(total.alias("total"), drawn.alias("drawn"), F.array().cast("array<bigint>").alias("out"))
        left = F.aggregate("quotas", start, draw, lambda a: a["out"])
        halves = F.flatten(F.transform(F.array(left), lambda l: F.array(
            F.struct(F.col("first").alias("first"), left_shards.alias("shards"), l.alias("quotas")),
            F.struct((F.col("first") + left_shards).alias("first"), (F.col("shards") - left_shards).alias("shards"),
                     F.zip_with("quotas", l, lambda q, x: q - x).alias("quotas")))))
        nodes = nodes.select(F.inline(halves)).where("shards > 0")
        if level == 9:  # many nodes: let other tasks go on with them
            nodes = nodes.repartition("first")
    return nodes.select(F.col("first").alias("shard"), "quotas")


def _starts(shards: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``starts``: for each source the number of its first draw in every shard."""
    each = shards.select("shard", F.posexplode("quotas").alias("i", "q")).select("shard", (F.col("i") + 1).alias("rank"), "q")
    running = F.aggregate("q", F.array(F.lit(0).cast("long")), lambda a, q: F.concat(a, F.array(F.element_at(a, -1) + q)))
    starts = (each.groupBy(F.col("rank").cast("long").alias("rank"))
              .agg(F.sort_array(F.collect_list(F.struct("shard", "q"))).alias("all"))
              .select("rank", F.col("all.q").alias("q")).select("rank", running.alias("starts")))
    return plan.join(starts, "rank", "left")


def _fitting(units: DataFrame) -> DataFrame:
    """(rank, left, picks) by source: the documents of one block that fit into ``gap`` words, and the words left.

    Equal rows are one unit with a count; units are tried by size, the largest
    first, and as many of each are picked as fit.  A block holds so many words by its
    construction that its units make a bounded array.
    """
    def pick(a: Column, u: Column) -> Column:
        n = F.least(u["n"], F.floor(a["gap"] / u["size"]).cast("long"))
        return F.struct((a["gap"] - n * u["size"]).alias("gap"), F.when(n > 0, F.concat(a["out"], F.array(
            F.struct(u["unit"].alias("unit"), n.alias("picked"))))).otherwise(a["out"]).alias("out"))

    start = F.struct(F.col("gap"), F.array().cast("array<struct<unit:bigint,picked:bigint>>").alias("out"))
    return (units.groupBy("rank", "gap", "unit", "size").agg(F.count("*").alias("n"))
            .groupBy("rank", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "unit", "n")), False).alias("units"))
            .select("rank", F.aggregate("units", start, pick).alias("a"))
            .select("rank", F.col("a.gap").alias("left"), F.col("a.out").alias("picks")))


def _falls(blocks: DataFrame) -> DataFrame:
    """(rank, end, gap): the place at which the running total of ``words`` passes ``rest``, and the words left there.

    ``blocks`` has rank, place, blocks, words and rest; a source whose words
    do not pass its rest has no row.
    """
    stepped = blocks.withColumn("step", F.floor(F.col("place") * F.lit(STEPS) / F.col("blocks")))
    before = F.col("run") - F.col("words")
    falls_here = (before <= F.col("rest")) & (F.col("rest") < F.col("run"))
    run = Window.partitionBy("rank")
    step = (stepped.groupBy("rank", "rest", "step").agg(F.sum("words").alias("words"))
            .withColumn("run", F.sum("words").over(run.orderBy("step"))).where(falls_here)
            .select("rank", "step", before.alias("first")))
    return (stepped.join(step, ["rank", "step"])
            .withColumn("run", F.col("first") + F.sum("words").over(run.orderBy("place"))).where(falls_here)
            .select("rank", F.col("place").alias("end"), (F.col("rest") - before).alias("gap")))


def _carried(rows: DataFrame, first: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The picks (rank, unit, picked) of ``first`` and of the blocks after it, and ranges of blocks taken by size.

    ``rows`` has rank, place, blocks, unit and size of the untaken rows after
    each source's last block, ``first`` (rank, end, left, picks) what that block gave.  A
    range (rank, after, upto, most) stands for all rows up to ``most`` words
    in the blocks between.  Where the words left fall, the block's picks leave
    less than half of them, so the rounds are at most the logarithm of a block's words.
    """
    picks, ranges, state = first.select("rank", F.inline("picks")), None, first.where("left > 0")
    while True:
        state = state.select("rank", F.col("end").alias("after"), F.col("left").alias("rest"))
        fit = materialize(rows.join(state, "rank").where("place > after and size <= rest"), "fit")
        if fit.isEmpty():
            return picks, ranges
        ends = materialize(_falls(fit.groupBy("rank", "place", "blocks", "rest").agg(F.sum("size").alias("words"))), "falls")
        more = (fit.select("rank", "after", "rest").distinct().join(ends, "rank", "left")
                .select("rank", "after", F.col("end").alias("upto"), F.col("rest").alias("most")))
        ranges = more if ranges is None else ranges.unionByName(more)
        here = fit.join(ends.where("gap > 0"), "rank").where("place = end and size <= gap")
        given = materialize(_fitting(here.select("rank", "gap", "unit", "size")), "picks")
        picks = picks.unionByName(given.select("rank", F.inline("picks")))
        state = ends.where("gap > 0").join(given, "rank", "left").select(
            "rank", "end", F.coalesce("left", "gap").alias("left")).where("left > 0")


def plan_mix(docs: DataFrame, keys: list[str], source: str = "source", text: str = "text", most: int = 3,
             weights: tuple[int, ...] = (1, 2, 3), shards: int = 64, block_words: int = 1 << 14,
             seed: int = 1) -> DataFrame:
    """Key columns, source, size, source_size, target, unit (a hash of the row) and draws of every row.

    ``size`` is the number of words (null: 0); ``draws`` has a struct (pass,
    shard) for each time that the mix takes the row, none if it does
    not.  Rows without words are never drawn.  No row is drawn over ``most``
    times.  Equal rows (of key and text) are told apart only by how many of
    them are drawn.  Null sources are a source of their own; an empty table
    gives an empty result.  The same rows always give the same draws.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    base = materialize(docs.select(*keys, F.col(source).cast("string").alias("source"), size.alias("size"),
                                   F.xxhash64(F.lit(seed), *keys, source, text).alias("unit")), "sizes")
    goal = F.round(F.col("target")).cast("long")
    plan = materialize(
        targets(base.groupBy("source").agg(F.sum("size").alias("size")), most, weights)
        .withColumn("passes", F.when(F.col("size") > 0, F.floor(goal / F.col("size"))).otherwise(0).cast("long"))
        .withColumn("rest", goal - F.col("passes") * F.col("size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("size") / block_words)).cast("long"))
        .withColumnRenamed("size", "source_size"), "sources")

    own = plan.select(F.col("source").alias("from"), "rank", "source_size", "target", "passes", "rest", "blocks")
    rows = base.join(own, F.col("source").eqNullSafe(F.col("from"))).drop("from").withColumn(
        "block", F.pmod("unit", "blocks"))

    def place(of_pass: Column) -> Column:
        return permuted(F.col("block"), F.col("blocks"), F.lit(seed), F.col("rank"), of_pass)

    blocks = materialize(
        rows.where("size > 0").groupBy("rank", "block", "blocks", "passes", "rest").agg(F.sum("size").alias("words"))
        .withColumn("place", place(F.col("passes"))), "blocks")
    # where the last pass of each source ends: a block, and the words left there
    end = _falls(blocks.where("rest > 0"))
    quota = F.col("passes") * F.col("blocks") + F.when(F.col("gap").isNotNull(), F.col("end") + 1).otherwise(0)
    plan = materialize(plan.join(end, "rank", "left").select("rank", "end", "gap", quota.alias("quota")), "ends")
    quotas = plan.agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(
        F.col("q.quota").alias("quotas"))
    plan = materialize(_starts(split_quotas(quotas, shards, seed), plan), "starts")

    def drawn(k: Column) -> Column:
        number = k * F.col("blocks") + F.when(k == F.col("passes"), F.col("place")).otherwise(place(k))
        return _let(number, lambda d: F.struct(k.cast("int").alias("pass"), _shard(F.col("starts"), d, shards).alias("shard")))

    # the draws of each block; the last block of a source tells its gap, and its rows and those after it take part in
    # the last pass by fit, with its draw as their extra one
    times = F.col("passes") + (F.col("gap").isNotNull() & (F.col("place") < F.col("end"))).cast("long")
    blocks = materialize(blocks.join(plan, "rank").select(
        "rank", "block", "place", F.when(F.col("place") == F.col("end"), F.col("gap")).alias("gap"),
        F.when(F.col("place") == F.col("end"), drawn(F.col("passes"))).alias("extra"),
        F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), times - 1), drawn)).otherwise(
            F.array().cast("array<struct<pass:int,shard:int>>")).alias("draws")), "draws")
    rows = rows.join(blocks.drop("extra"), ["rank", "block"], "left")
    last = F.col("gap").isNotNull() & (F.col("size") > 0)
    ends = blocks.where("gap is not null").select("rank", F.col("place").alias("end"), "gap", F.col("extra"))
    given = _fitting(rows.where(last).select("rank", "gap", "unit", "size"))
    given = materialize(ends.join(given, "rank", "left").select(
        "rank", "end", F.coalesce("left", "gap").alias("left"),
        F.coalesce("picks", F.array().cast("array<struct<unit:bigint,picked:bigint>>")).alias("picks")), "picks")
    after = rows.join(ends.select("rank", "end"), "rank").where("place > end and size > 0")
    picks, ranges = _carried(after.select("rank", "place", "blocks", "unit", "size"), given)
    rows = rows.join(ends.select("rank", "end", "extra"), "rank", "left")
    taken = F.lit(False)
    if ranges is not None:
        ranges = ranges.groupBy("rank").agg(F.collect_list(F.struct("after", "upto", "most")).alias("ranges"))
        rows = rows.join(ranges, "rank", "left")
        taken = F.coalesce(F.exists("ranges", lambda r: (F.col("place") > r["after"]) & (F.col("size") <= r["most"]) & (
            r["upto"].isNull() | (F.col("place") < r["upto"]))), F.lit(False))
    picks = materialize(picks.groupBy("rank", "unit").agg(F.sum("picked").alias("picked")), "picked")
    rows = rows.join(picks, ["rank", "unit"], "left").withColumn("taken", taken)
    nth = F.row_number().over(Window.partitionBy("rank", "unit").orderBy("unit"))
    names = [*keys, "source", "size", "source_size", "target", "unit"]
    none = F.array().cast("array<struct<pass:int,shard:int>>")
    whole = F.when((F.col("size") > 0) & F.col("draws").isNotNull(), F.col("draws")).otherwise(none)
    chosen = F.col("picked").isNotNull() & ~F.col("taken")
    tried = rows.where(chosen).select(*names, F.when(nth <= F.col("picked"), F.concat("draws", F.array("extra"))).otherwise(
        F.col("draws")).alias("draws"))
    return rows.where(~chosen).select(*names, F.when((F.col("size") > 0) & F.col("taken"), F.concat(
        "draws", F.array("extra"))).otherwise(whole).alias("draws")).unionByName(tried)


def _shard(starts: Column, number: Column, shards: int) -> Column:
    """The last shard whose first draw is not after ``number``, by bisection."""
    halves = [1 << b for b in reversed(range(max(1, (shards - 1).bit_length())))]

    def further(at: Column, by: Column) -> Column:
        return F.when((at + by < shards) & (F.get(starts, at + by) <= number), at + by).otherwise(at)

    return F.aggregate(F.array(*(F.lit(h) for h in halves)), F.lit(0), further)


def mix(docs: DataFrame, row: str, shards: int = 64, **options) -> DataFrame:
    """The rows of ``docs`` as the mix draws them: once per draw, by shard, shuffled within each.

    ``row`` names a column with a unique value per row; it is kept.
    """
    drawn = plan_mix(docs, [row], shards=shards, **options).select(row, "unit", F.inline("draws")).select(
        row, F.col("shard").alias("__shard"), F.xxhash64("unit", "pass", "shard").alias("__place"))
    return (docs.join(drawn, row).repartition("__shard").sortWithinPartitions("__shard", "__place", row)
            .select(*docs.columns))
