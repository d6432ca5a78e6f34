"""Exact top-k search: brute force, and what goes through the driver."""

from __future__ import annotations

import random

from rightsweave.llm import topk


def _table(spark, n, dim=6, seed=3):
    draw = random.Random(seed)
    data = [(i, [draw.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    data += [(-50, None), (None, [0.5] * dim), (100, [0.25] * dim), (150, [0.5] * (dim + 1)), (151, [0.25] * (dim + 1)),
             (200, [float("nan")] * dim)]
    return data, spark.createDataFrame(data, "vec_id long, embedding array<double>")


def _brute(data, k, every):
    held = [(i, [int(256 * x // 1) for x in v]) for i, v in data if v is not None and all(x == x for x in v)]
    found = []
    for at, (q, a) in enumerate(held):
        if q is None or q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for o, (i, b) in enumerate(held)
                        if o != at and len(b) == len(a))[:k]
        found += [(q, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(scored)]
    return sorted(found, key=str)


def test_equals_brute_force_over_several_segments(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "BLOCKS", 2)
    monkeypatch.setattr(topk, "CHUNK", 3)
    data, df = _table(spark, 400)
    got = topk.top_k(df, k=5, every=25)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(data, 5, 25)


def test_copies_of_the_queries_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "BLOCKS", 2)
    _, df = _table(spark, 2000)
    plan = topk.top_k(df, every=25)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_copies_of_the_queries_follow_the_tasks():
    assert topk._buckets(1, 12) == 1 and topk._buckets(40, 12) == 10
    assert topk._buckets(10_000, 12) == topk._buckets(1_000_000, 12) == topk.COPIES * 12
