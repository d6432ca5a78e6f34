"""Periodic runs against a plain search over all periods."""

import hashlib
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rightsweave.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(24, 3 * q):
                best.setdefault((start, i + q), q)
            i += 1
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, planted=True):
    w = WORD.findall(text or "")
    n = len(w)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    top = None
    for r in found:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{a},{m},{q}\n" for a, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def check(frame, planted=True, longest=3000):
    got = sorted((tuple(r) for r in runs.periodic_runs(frame, planted=planted).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    long = {i for i, t in rows if len(WORD.findall(t or "")) > longest}  # the plain search is quadratic
    want = sorted((brute_row(i, t, planted) for i, t in rows if i not in long), key=str)
    assert [g for g in got if g[0] not in long] == want and len(got) == len(rows)
    return got


def test_all_documents(docs):
    got = check(docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_edge_rows(edge, no_docs):
    got = {r[0]: r for r in check(edge, planted=False, longest=10_000)}
    assert got[8][1:5] == (1, 0, 28000, 7)  # the very long text repeats seven words
    assert runs.periodic_runs(no_docs).count() == 0


words = st.lists(st.integers(0, 3), max_size=120)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, st.integers(1, 9), words), max_size=5))
def test_runs_of_repeated_pieces(parts):
    texts = [np.array([*a * k, *b, *a * 2], np.int64) for a, k, b in parts]
    assert runs.runs_of(texts) == [brute_runs(t.tolist()) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=200), st.data())
def test_extensions(codes, data):
    x = np.array(codes, np.int64)
    made = runs.Extensions(x)
    i = np.array(data.draw(st.lists(st.integers(0, len(x) - 1), min_size=1, max_size=20)))
    j = (i + 1 + np.array(data.draw(st.lists(st.integers(0, len(x) - 2), min_size=len(i), max_size=len(i))))) % len(x)
    keep = i != j
    want = []
    for a, b in zip(i[keep], j[keep]):
        n = 0
        while max(a, b) + n < len(x) and x[a + n] == x[b + n]:
            n += 1
        want.append(n)
    assert made.of(i[keep], j[keep]).tolist() == want


def test_the_cover_has_every_difference():
    assert {(a - b) % runs.PERIOD for a in runs.COVER for b in runs.COVER} == set(range(runs.PERIOD))


def test_very_long_texts():
    rng = np.random.default_rng(1)
    began = time.time()
    n = 300_000
    assert runs.runs_of([np.zeros(n, np.int64)]) == [[(0, n, 1)]]
    cycle = rng.integers(0, 10 ** 6, n // 5)
    assert runs.runs_of([np.resize(cycle, n)]) == [[(0, n, n // 5)]]
    assert runs.runs_of([rng.integers(0, 10 ** 6, n)]) == [[]]
    assert time.time() - began < 60


def test_collapsed_documents(spark):
    line = "buy now and save today "
    frame = spark.createDataFrame([(1, "Before it. " + line * 6 + "after"), (2, "no  run here"), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in runs.collapse_runs(frame).collect()}
    assert out == {1: "Before it. buy now and save today after", 2: "no  run here", 3: None}
