"""SimHash groups against all pairs, and multi-index lookups against the distance itself."""

import random
import re

import pytest
import xxhash

from rightsweave.llm import simhash
from rightsweave.llm.components import connected_components


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else (
        [" ".join(words)] if words else [])
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_groups(values, near):
    """Smallest member of each value's component, by union-find over all pairs."""
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in values:
        for b in values:
            if a < b and near(a, b) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def bits(a, b):
    return bin((a ^ b) & (2 ** 64 - 1)).count("1")


def check(frame):
    rows = frame.collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.simhash_components(frame).collect())
    fps = [brute_fingerprint(r.text) for r in rows]
    comp = brute_groups(set(fps), lambda a, b: bits(a, b) <= 2)
    least = {}
    for r, f in zip(rows, fps):
        if r.doc_id is not None:
            least[comp[f]] = min(least.get(comp[f], r.doc_id), r.doc_id)
    assert got == sorted((r.doc_id is None, r.doc_id or 0, f"{f:016x}", least.get(comp[f])) for r, f in zip(rows, fps))


def test_all_documents(docs):
    check(docs)


def test_edge_rows(edge):
    check(edge)


def test_empty_table(no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    assert simhash.drop_near_copies(no_docs).columns == no_docs.columns


@pytest.mark.parametrize("distance,segments,bucket", [(2, 2, 64), (2, 2, 2), (2, 3, 64), (2, 4, 3), (3, 2, 64), (3, 2, 2),
                                                      (1, 2, 1), (0, 2, 64), (3, 4, 5)])
def test_links_join_the_same_groups(spark, distance, segments, bucket):
    random.seed(distance * 10 + segments)
    centres = [random.getrandbits(64) for _ in range(12)]
    values = set(centres)
    for c in centres:
        for _ in range(20):
            values.add(c ^ sum({1 << random.choice([1, 5, 33, 40, 62, 63, 20]) for _ in range(3)}))
    longs = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.hamming_links(spark.createDataFrame([(v,) for v in longs], "fp long"), distance, segments, bucket)
    pairs = links.collect()
    assert all(bits(a, b) <= distance for a, b in pairs)
    roots = dict(connected_components(links).collect())
    want = brute_groups(longs, lambda a, b: bits(a, b) <= distance)
    assert {v: roots.get(v, v) for v in longs} == want


def test_one_of_each_group_stays(edge):
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    groups = {r.component_id for r in simhash.simhash_components(edge.where("doc_id is not null")).collect()}
    assert set(i for i in ids if i is not None) == groups and len(ids) == len(groups) + 1  # and one of the rows without an id


def test_repeated_ids_of_different_texts_stay(spark):
    rows = [(5, "one text about rivers and bridges"), (5, "another text on apples, pears and plums"),
            (6, "another text on apples, pears and plums")]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:2])


def test_components_of_lines_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (None, 5)]
    got = dict(connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
