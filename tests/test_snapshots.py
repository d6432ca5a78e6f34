"""Snapshots under interleaved, repeated and cut-off writes."""

import os
import uuid

import pytest
from helpers import rows

from rightsweave.session import scratch_dir
from rightsweave.sources import snapshots


def _root(spark):
    return f"{scratch_dir(spark)}/rightsweave-tests/{uuid.uuid4().hex}/table"


def test_interleaved_writers_give_one_whole_snapshot(spark):
    root = _root(spark)
    a = snapshots.stage(spark.range(0, 50).selectExpr("id", "id % 3 AS part"), root, "part")
    b = snapshots.stage(spark.range(100, 170).selectExpr("id", "id % 3 AS part"), root, "part")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    assert snapshots.commit(spark, root, b).version == 1
    assert rows(snapshots.read(spark, root), "id") == [(i,) for i in range(100, 170)]
    done = snapshots.commit(spark, root, a)
    assert (done.version, done.rows) == (2, 50)
    assert snapshots.read(spark, root).columns == ["id", "part"]
    assert rows(snapshots.read(spark, root), "id") == [(i,) for i in range(50)]
    assert rows(snapshots.read(spark, root, 1), "id") == [(i,) for i in range(100, 170)]
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root, 3)


def test_writers_of_the_same_version_agree(spark, monkeypatch):
    root = _root(spark)
    staged = [snapshots.stage(spark.range(n), root) for n in (3, 4)]
    monkeypatch.setattr(snapshots, "_names", lambda *_: [])  # both saw an empty table
    assert [snapshots.commit(spark, root, s).version for s in staged] == [1, 1]
    monkeypatch.undo()
    wins = max(staged, key=lambda s: s.snapshot)
    assert snapshots.newest(spark, root).snapshot == wins.snapshot and snapshots.read(spark, root).count() == wins.rows


def test_cut_off_writes_are_never_read(spark):
    root = _root(spark)
    assert snapshots.newest(spark, root) is None
    snapshots.stage(spark.range(5), root)  # data without a manifest
    os.makedirs(f"{root}/manifests")
    with open(f"{root}/manifests/.000000000009-x.json", "w") as half:
        half.write('{"snapshot": ')
    calls = []

    def compute():
        calls.append(1)
        return spark.range(7)

    assert snapshots.read_or_compute(spark, root, compute).count() == 7
    assert snapshots.read_or_compute(spark, root, compute).count() == 7 and calls == [1]

    def fails():
        raise ValueError("no input")

    other = _root(spark)
    with pytest.raises(ValueError):
        snapshots.read_or_compute(spark, other, fails)
    assert snapshots.newest(spark, other) is None
    snapshots.write(spark.range(0), other)
    assert snapshots.read(spark, other).collect() == []
