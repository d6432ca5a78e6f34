"""Mixing: targets against plain water filling, quotas against exact sums, and draws near the targets."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from rightsweave.llm import mixing
from rightsweave.llm.common import identified


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Shares by weight, cut at three times a source's size, the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check(docs, slack):
    rows = mixing.plan_mix(docs, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == words(r.text) and len(r.draws) <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * len(r.draws)
        assert [d["pass"] for d in r.draws] == list(range(len(r.draws)))
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
    for s in sizes:
        assert taken[s] <= round(want[s])
        assert want[s] - taken[s] <= slack, (s, want[s], taken[s])
    return rows


def test_all_documents_come_near_their_targets(docs):
    check(docs, slack=150)


def test_edge_rows(edge):
    check(edge, slack=30_000)  # one text is most of all words


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * 3, "a") for i in range(5)] + [(i, "w " * 40, "b") for i in range(5, 60)] + [(i, "w", None) for i in range(60, 90)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"), slack=40)


def test_empty_table_and_no_words(spark, no_docs):
    assert mixing.plan_mix(no_docs, ["doc_id"]).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.draws) for r in mixing.plan_mix(blank, ["doc_id"]).collect()] == [(0, 0.0, [])] * 2


def test_reruns_agree(docs):
    first, again = (sorted((r.doc_id, [tuple(d) for d in r.draws]) for r in mixing.plan_mix(docs, ["doc_id"]).collect())
                    for _ in range(2))
    assert first == again


def test_blocks_are_disjoint_and_shards_even(docs):
    rows = mixing.plan_mix(docs, ["doc_id"], shards=5, block_words=200).collect()
    per = Counter(d["shard"] for r in rows for d in r.draws)
    assert set(per) == set(range(5)) and max(per.values()) < 3 * min(per.values())


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    assert [r.p for r in got] != list(range(1000))


def test_split_keeps_quotas_and_draws_hypergeometric(spark):
    quotas = [1000, 0, 300, 7]
    one = spark.createDataFrame([(quotas,)], "quotas array<long>")
    rows = mixing.split_quotas(one, 16, 3).collect()
    assert sorted(r.shard for r in rows) == list(range(16))
    assert [sum(c) for c in zip(*(r.quotas for r in rows))] == quotas
    assert {sum(r.quotas) for r in rows} <= {81, 82}
    # the share of a source in the left half over many seeds: mean and variance of the distribution
    draws = spark.range(4000).select(mixing.hypergeometric(
        F.lit(100), F.lit(30), F.lit(40), mixing._uniform(F.col("id"))).alias("x")).collect()
    x = [r.x for r in draws]
    mean = sum(x) / len(x)
    var = sum((v - mean) ** 2 for v in x) / len(x)
    assert abs(mean - 12) < 0.15 and abs(var - 40 * .3 * .7 * 60 / 99) < 0.4 and min(x) >= 0 and max(x) <= 30


def test_mix_returns_whole_rows_as_often_as_drawn(edge):
    rows, row = identified(edge)
    plan = {r[row]: len(r.draws) for r in mixing.plan_mix(rows, [row]).collect()}
    mixed = mixing.mix(rows, row, shards=4)
    assert mixed.columns == rows.columns
    assert Counter(r[row] for r in mixed.collect()) == Counter({k: v for k, v in plan.items() if v})


def test_a_huge_document_leaves_no_gap(spark):
    # one document is a third of its source; wherever the target falls, small ones of other blocks fill it
    for other in (600, 900):
        rows = [(0, "w " * 500, "a")] + [(i, "w " * (1 + i % 7), "a") for i in range(1, 251)] + [(1000, "w " * other, "b")]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = mixing.plan_mix(frame, ["doc_id"], weights=(1, 3), block_words=100).collect()
        mine = [r for r in got if r.source == "a"]
        left = round(mine[0].target) - sum(r.size * len(r.draws) for r in mine)
        most = max(len(r.draws) for r in mine)
        untaken = [r.size for r in mine if len(r.draws) <= round(mine[0].target) // mine[0].source_size]
        assert most <= 3 and 0 <= left < min(untaken, default=1 << 30), (other, left)
