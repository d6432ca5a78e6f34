"""Hard negatives against all scores."""

import numpy as np
import pytest

from rightsweave.llm import negatives

SF = "/root/testdata/sf0.001"


def floors(v, scale=256):
    if v is None or any(x is None or not np.isfinite(x) for x in v):
        return None
    return [int(np.floor(scale * float(x))) for x in v]


def brute(rows, every=100, k=5, m=5, low=80, high=100):
    """rows: (id, vector, label); one tuple for each mined row."""
    able = [(i, floors(v), y, n) for n, (i, v, y) in enumerate(rows) if y is not None and floors(v) is not None]
    out = []
    rank = lambda e: (-e[0], e[1] is None, e[1] or 0, e[2])
    for i, v, y, n in able:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, o, z) for j, w, z, o in able if o != n and len(w) == len(v)]
        for score, j, o, z in sorted((s for s in scored if s[3] == y), key=rank)[:k]:
            found = sorted((s for s in scored if s[3] != y and low * score <= 100 * s[0] <= high * score), key=rank)[:m]
            out += [(i, j, r + 1, s[1], score, s[0]) for r, s in enumerate(found)]
    return sorted(out, key=str)


def check(frame, **options):
    got = sorted((tuple(r) for r in negatives.hard_negatives(frame, **options).collect()), key=str)
    want = brute([(r.vec_id, r.embedding, r.label) for r in frame.collect()], **{k: v for k, v in options.items() if k == "every"})
    assert got == want
    return got


def test_all_vectors(spark):
    assert len(check(spark.read.parquet(f"{SF}/embeddings.parquet"), every=20)) > 100


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SEGMENT", 16), ("BLOCK", 4), ("CHUNK", 4), ("PACK", 3), ("REACH", 2)):
        monkeypatch.setattr(negatives, name, value)


def test_clusters_in_many_segments(spark, small):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((6, 8))
    rows = [(i, [float(x) for x in centers[i % 6] * (1 + i % 3) + 0.2 * rng.standard_normal(8)], int(rng.integers(3))) for i in range(240)]
    rows += [(40, rows[40][1], 1)] * 3 + [(500 + i, rows[0][1], i % 2) for i in range(30)]  # repeated rows, equal vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert len(check(frame, every=10)) > 50


def test_windows_leave_most_rows_unscored(spark, small, monkeypatch):
    """Pairs of chunk and segment are fewer than all where vectors lie in clusters."""
    rng = np.random.default_rng(4)
    centers = np.eye(12)
    rows = [(i, [float(x) for x in centers[i % 12] + 0.02 * rng.standard_normal(12)], i % 2) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    chosen, real = [], negatives.chosen_pairs

    def counted(chunks, segments, same):
        out = real(chunks, segments, same)
        chosen.append((out.count(), chunks.count() * segments.count()))
        return out

    monkeypatch.setattr(negatives, "chosen_pairs", counted)
    check(frame, every=10)
    assert chosen[1][0] < 0.5 * chosen[1][1]


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (None, [0.9, 0.5], 2), (None, [1.0, 0.4], 1), (3, None, 1),
            (4, [1.0, None], 2), (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 1), (7, [0.95, 0.5], None), (8, [0.0, 0.0], 2),
            (200, [0.0, 0.0], 1), (300, [], 1), (301, [], 1), (302, [], 2), (400, [1.0, 2.0, 3.0], 1), (401, [1.0, 2.0, 3.0], 2),
            (402, [1.0, 2.0, 2.9], 1), (9, [-1.0, -0.5], 2), (500, [-1.0, -0.4], 1), (600, [1e6, -1e6], 1), (601, [1e6, -9e5], 1),
            (602, [9e5, -1e6], 2), (10, [0.9, 0.55], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = check(frame)
    assert any(g[3] is None for g in got) and any(g[4] > 1 << 53 for g in got)
    extra = frame.selectExpr("*", "label as row", "vec_id as number", "'x' as floors")
    assert sorted((tuple(r) for r in negatives.hard_negatives(extra).collect()), key=str) == got
    assert negatives.hard_negatives(frame.limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(-300, 300, (40, 5)) * rng.integers(1, 5, (40, 1)) for _ in "ab")
    refs = rng.standard_normal((4, 5))
    refs /= np.sqrt((refs * refs).sum(1, keepdims=True))

    def pack(x):
        norms, cosines = negatives._against(x, refs)
        n = np.arange(len(x))
        return negatives.Pack({"ids": n.astype("<i8").tobytes(), "rows": n.astype("<i8").tobytes(), "labels": n.astype("<i8").tobytes(),
                               "kind": "<i8", "vectors": x.astype("<i8").tobytes(), "dim": 5, "norms": norms.tobytes(),
                               "cosines": cosines.tobytes()})

    cuts = [slice(i, i + 7) for i in range(0, 40, 7)]
    lower, upper = negatives._between(pack(a).ranges(cuts), pack(b).ranges(cuts))
    scores = a @ b.T
    for i, c in enumerate(cuts):
        for j, d in enumerate(cuts):
            assert lower[i, j] <= scores[c, d].min() and scores[c, d].max() <= upper[i, j]
