"""A chain table that follows changes against one that is built again."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_chains import CHAIN_DDL, contract

from rightsweave.functions.arrays import key_string
from rightsweave.plans import chain_table, chains


def frame(spark, contracts):
    return spark.createDataFrame(list(contracts.values()), CHAIN_DDL)


def keyed(df):
    return rows(df.select(key_string("chain").alias("chain"), F.to_json("assignors").alias("a"), F.to_json("assignees").alias("b"),
                          key_string("territories").alias("t"), "assignable", "contract_type"))


def written(path, version):
    return [f for d, _, names in os.walk(f"{path}/rows/version={version}") for f in names if f.endswith(".parquet")]


def test_rounds_of_changes(spark, tmp_path):
    path = str(tmp_path / "table")
    now = {i: contract(i, [i], [i + 1, i + 2] if i % 4 else [i + 1]) for i in range(1, 25)}
    chain_table.create(frame(spark, now), 3, path)
    rounds = [
        {5: contract(5, [5], [6, 9]), 30: contract(30, [6], [3])},  # one changed, one added that closes a cycle
        {7: None, 8: contract(8, [8], [9], assignable=0)},  # one gone, one that no longer extends
        {7: contract(7, [7], [8, 20], territories=(2, 3)), 5: None, 30: None},
    ]
    for change in rounds:
        now = {k: v for k, v in {**now, **change}.items() if v is not None}
        given = frame(spark, now).where(F.get(F.col("chain"), 0).isin(list(change)))
        chain_table.apply_changes(spark, path, given, spark.createDataFrame([(k,) for k in change], "numctr long"), 3)
        base = frame(spark, now)
        assert keyed(chain_table.chain_rows(spark, path, base)) == keyed(chains.build(base, 3))


def test_a_small_change_writes_few_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    contracts = {i: contract(i, [i], [i + 1]) for i in range(1, 400)}
    chain_table.create(frame(spark, contracts), 3, path)
    changed = contract(200, [200], [201], pct=50.0)
    chain_table.apply_changes(spark, path, frame(spark, {200: changed}), spark.createDataFrame([(200,)], "numctr long"), 3)
    count = lambda v: spark.read.parquet(f"{path}/rows/version={v}").count()
    assert count(0) > 1500 and count(1) < 40
    assert keyed(chain_table.chain_rows(spark, path, frame(spark, contracts))) == keyed(
        chains.build(frame(spark, {**contracts, 200: changed}), 3))


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    base = frame(spark, {i: contract(i, [i], [i + 1]) for i in range(1, 9)})
    chain_table.create(base, 2, path)
    before = keyed(chain_table.chain_rows(spark, path, base))
    chain_table._write(base, path, 1, 0)  # cut off before its changes are written
    assert chain_table.versions(spark, path) == [0]
    assert keyed(chain_table.chain_rows(spark, path, base)) == before
    chain_table.apply_changes(spark, path, base.limit(0), spark.createDataFrame([(4,)], "numctr long"), 2)
    assert {"4"} & {c for r in keyed(chain_table.chain_rows(spark, path, base)) for c in r[0].split("|")} == set()


def test_no_changes(spark, tmp_path):
    path = str(tmp_path / "table")
    base = frame(spark, {i: contract(i, [i], [i + 1]) for i in range(1, 5)})
    chain_table.create(base, 2, path)
    chain_table.apply_changes(spark, path, base, spark.createDataFrame([], "numctr long"), 2)
    assert keyed(chain_table.chain_rows(spark, path, base)) == keyed(chains.build(base, 2))


@pytest.mark.parametrize("depth", [0, 1])
def test_depths(spark, tmp_path, depth):
    path = str(tmp_path / "table")
    now = {i: contract(i, [i], [i + 1]) for i in range(1, 6)}
    chain_table.create(frame(spark, now), depth, path)
    now[3] = contract(3, [3], [1])
    chain_table.apply_changes(spark, path, frame(spark, {3: now[3]}), spark.createDataFrame([(3,)], "numctr long"), depth)
    assert keyed(chain_table.chain_rows(spark, path, frame(spark, now))) == keyed(chains.build(frame(spark, now), depth))
