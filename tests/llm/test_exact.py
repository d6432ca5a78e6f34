"""Exact dedup against grouping in plain Python."""

import hashlib

import pytest

from rightsweave.llm import exact

BLANK = str.maketrans("", "", " \t\n\v\f\r")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(BLANK), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), not k, sha) for k, m in enumerate(members)]
    return sorted(out, key=str)


def check(frame):
    got = exact.exact_groups(frame)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(r.doc_id, r.text) for r in frame.collect()])


def test_all_documents(docs):
    check(docs)


def test_edge_rows(edge):
    check(edge)


def test_empty_table(no_docs):
    assert exact.exact_groups(no_docs).count() == 0
    assert exact.drop_exact_copies(no_docs).columns == no_docs.columns


@pytest.fixture
def few_held(monkeypatch):
    monkeypatch.setattr(exact, "HELD", 3)


def test_groups_over_many_partitions(spark, few_held):
    head = "the same beginning of many texts " * 4
    rows = [(i, "hot  text" if i % 3 else f"{head}{i % 40}") for i in range(3000)] + [(7, "hot text")] * 500 + [(None, "hottext")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(frame)
        dealt = exact._normalised(frame, ["doc_id"], "text").repartitionByRange("head", "digest", "length", "no_id", "doc_id", "row")
        sizes = [n for n in dealt.rdd.glom().map(len).collect() if n]
        assert max(sizes) < 0.2 * sum(sizes)  # a group with two thirds of the rows is dealt out
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_digests_that_collide(spark, monkeypatch):
    """Texts are told apart in full also where beginnings and digests are equal."""
    import pyarrow as pa

    schema = pa.schema([("c0", pa.int64()), ("run", pa.int64()), ("lead", pa.bool_()), ("size", pa.int64()), ("keep", pa.int64()),
                        ("sha", pa.string()), ("body", pa.binary()), ("length", pa.int64())])
    batch = pa.RecordBatch.from_pydict({
        "c0": [1, 2, 3, 4], "length": [1, 1, 1, 1], "no_id": [False] * 4, "doc_id": [1, 2, 3, 4], "row": [1, 2, 3, 4],
        "head": [b"x"] * 4, "digest": [b"d"] * 4, "body": [b"xa", b"xa", b"xb", b"xc"]})
    out = pa.Table.from_batches(list(exact._neighbours(iter([batch]), 1, schema, 0))).to_pylist()
    runs = {r["body"]: r["size"] for r in out if r["lead"] is None}
    assert runs == {b"xa": 2, b"xb": 1, b"xc": 1}  # all of one digest at a partition's ends go on to the grouping
    assert [(r["c0"], r["run"], r["lead"]) for r in out if r["lead"] is not None] == [(1, 0, True), (2, 0, False), (3, 1, True), (4, 2, True)]


def test_copies_are_dropped(edge):
    kept = exact.drop_exact_copies(edge)
    want = [w for w in brute([(r.doc_id, r.text) for r in edge.collect()]) if w[3]]
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want)


def test_clashing_names(spark):
    frame = spark.createDataFrame([(1, "a", 5, "x"), (2, " a", 6, "y")], "doc_id long, text string, Kept int, `a.b` string")
    got = exact.exact_groups(frame, ["doc_id", "Kept", "a.b"])
    assert got.columns == ["doc_id", "Kept", "a.b", "keep_id", "group_size", "kept_", "text_sha256"]
    assert sorted(tuple(r)[:6] for r in got.collect()) == [(1, 5, "x", 2, 2, False), (2, 6, "y", 2, 2, True)]
