"""Top-k search and near-duplicate vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from rightsweave.llm import topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, signs string, dim string, `rank` string"


def odd_vectors():
    random.seed(11)
    base = [[random.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(i, v, i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, [x + random.gauss(0, 0.03) for x in base[i % 5]], i % 5 % 3) for i in range(40)]  # near copies
    rows += [(200 + 50 * i, base[0], 0) for i in range(4)]  # exact copies, also queries
    rows += [(200, base[0], 0), (None, base[0], 0), (None, base[1], None), (50, base[2], None)]  # repeated and null ids, no label
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 8, 0), (403, [1.0, None] * 4, 0), (404, [math.nan] * 8, 0),
             (405, [math.inf] + [0.0] * 7, 0), (450, [1.0, 2.0], 0), (451, [1.0, 2.0], 0), (452, [-3.0, 2.0], 0)]
    return [(i, v, y, "r", "s", "d", "k") for i, v, y in rows]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, k):
    ints = [[math.floor(256 * float(np.float32(x))) for x in v] if usable(v) else None for _, v, *_ in rows]
    out = []
    for i, (q, *_) in enumerate(rows):
        if q is None or q % 50 or ints[i] is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(ints[i], ints[j])), rows[j][0] is None, rows[j][0] or 0)
                        for j in range(len(rows)) if j != i and ints[j] is not None and len(ints[j]) == len(ints[i]))
        out += [(q, n + 1, None if null else c, -s) for n, (s, null, c) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,block", [(5, 256), (3, 4)])
def test_top_k_of_odd_rows(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = odd_vectors()
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), k=k).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_top(rows, k)


def test_search_prunes_and_stays_exact(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (20, 12))
    data = np.repeat(centres, 16, 0) + rng.integers(-20, 20, (320, 12))
    segment = topk.Segment(np.arange(320), np.arange(320), data.astype(float))
    for q in range(0, 320, 7):
        scores = data @ data[q]
        want = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        got = segment.search(data[q].astype(float), q, 5, topk.NONE)
        assert [(-s, i) for s, i, _ in got] == want
        floor = -want[2][0]
        assert [(-s, i) for s, i, _ in segment.search(data[q].astype(float), q, 5, floor)][:3] == want[:3]
        assert all(segment.bounds(data[q].astype(float))[b] >= scores[16 * b:16 * b + 16].max() for b in range(20))


def test_large_components_stay_exact():
    big = np.array([[2 ** 40, 3], [2 ** 40 + 1, -5]], dtype=np.int64)
    v, q = topk._numbers(big, big)
    assert v.dtype == object and int((v @ q[1])[0]) == 2 ** 40 * (2 ** 40 + 1) - 15


def cosine(a, b):
    a, b = (np.array([float(np.float32(x)) for x in v]) for v in (a, b))
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


def brute_near(rows):
    n = len(rows)
    ok = [r[2] is not None and usable(r[1]) and any(r[1]) for r in rows]
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
              and cosine(rows[i][1], rows[j][1]) >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), comp, rows[i][0] == comp))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [512, 4])
def test_near_vectors_of_odd_rows(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = odd_vectors()
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_near(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(none).count() == 0 and vectors.near_vectors(none).count() == 0


def test_tables_reach_the_recall_they_promise():
    for n in (100, 10_000, 10_000_000):
        bits, tables = vectors.tables_for(n, 0.98)
        same = (1 - math.acos(0.98) / math.pi) ** bits
        assert (1 - same) ** tables <= 1e-6 and 2 ** bits >= n


def test_vectors_of_extreme_length_link(spark):
    pairs = [([1e200, 1.0], [1e200, 2.0]), ([1e-200, 0.0], [2e-200, 0.0]), ([1e308, 1e308], [1.0, 1.0]), ([5e-324, 0.0], [3.0, 0.1]),
             ([1e200, 1.0], [1.0, 1e200])]
    rows = [(10 * i + j, v, i) for i, pair in enumerate(pairs) for j, v in enumerate(pair)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {10 * i + j: (1, 10 * i) if i < 4 else (0, 10 * i + j) for i in range(5) for j in range(2)}
