"""What intermediates leave on disk, and for how long."""

from __future__ import annotations

import glob
import time

from pyspark.sql import functions as F

from rightsweave.operators.distinct import distinct_rows
from rightsweave import registry
from rightsweave.plans import chain_table, chains, contracts, hubs, restitution
from rightsweave.sources import world as W
from rightsweave.session import discard_unread, materialize, materialize_alone, run_dir, tracked


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return {f for f in files.split("|") if "/shuffle_" in f}


def _gone(test) -> bool:
    return any(test() or time.sleep(0.2) for _ in range(50))


def test_shuffle_files_go_with_the_write(spark):
    before, setting = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    out = materialize(df, "grouped")
    assert _gone(lambda: _shuffle_files(spark) <= before)
    assert out.count() == 7 and df.count() == 7  # the frame itself can still be run
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_distinct_rows_read_again_are_plain(spark):
    df = spark.range(100).select((F.col("id") % 60).alias("a"), F.lit("x").alias("b"))
    with tracked() as paths:
        rows = distinct_rows(df, "t", again=True)
    assert sorted(r.a for r in rows.collect()) == list(range(60)) and rows.columns == ["a", "b"]
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [bool(glob.glob(f"{p.removeprefix('file:')}/*")) for p in paths].count(True) == 1


def test_what_a_frame_was_made_from_goes(spark):
    with tracked() as outer:
        alone = materialize_alone(lambda: materialize(spark.range(5), "a").union(materialize(spark.range(3), "b")), spark, "c")
        kept, unread = materialize(spark.range(2), "kept"), materialize(spark.range(2), "unread")
    assert alone.count() == 8 and len(outer) == 5 and all(p.startswith(run_dir(spark)) for p in outer)
    discard_unread(kept, outer[3:])
    assert kept.count() == 2
    assert [bool(glob.glob(f"{p.removeprefix('file:')}/*")) for p in outer] == [False, False, True, True, False]
    assert unread is not kept


def test_chains_go_to_requests_of_their_country_only(spark):
    chains = spark.createDataFrame([("DE", [1, 2], [7, 8], 7, 2)], "cdetypdrtsacem string, territories array<int>, "
                                   "chain array<int>, _first int, _len int")
    heads = spark.createDataFrame([(n, 7, 2, 1) for n in (0, 1, 2, None)], "_k_num int, _f int, _max_len int, _max_prio int")
    known = spark.createDataFrame([(0, "DE", 1), (1, "DE", 2), (2, "DR", 1), (None, "DE", 2), (None, "DE", 9), (0, "DE", 1)],
                                  "num int, cdetypdrtsacem string, code_iso4n_pays int")
    longest_of = F.col("_first").eqNullSafe(F.col("_f")) & (F.col("_len") == F.col("_max_len"))
    found = restitution._longest_of_requests(chains, heads, longest_of, known, ["num"], ["numcatal", "cdetypdrtsacem", "code_iso4n_pays"])
    assert {(r["_k_num"], r["code_iso4n_pays"]) for r in found.collect()} == {(0, 1), (1, 2), (None, 2)}
    assert found.count() == 3


SMALL = "/root/testdata/sf0.001"


def _left(paths) -> list[str]:
    return [p.rsplit("/", 1)[1] for p in paths if glob.glob(f"{p.removeprefix('file:')}/*")]


def test_scalar_base_gathers_valid_contracts_only(spark, monkeypatch):
    valid = contracts.valid_contracts(W.load_world(spark, SMALL)["contrat"], W.CONSULT_DATE).select("idctr")
    others = {}

    def counted(df, name):
        others[name] = df.join(valid, "idctr", "left_anti").count()
        return materialize(df, name)

    monkeypatch.setattr(contracts, "materialize", counted)
    with tracked() as paths:
        base = registry._scalar_base(spark, SMALL)
    assert others == {"scalar_sets": 0} and len(_left(paths)) == 1 and base.count() > 0


def test_base_and_level_leave_one_folder_each(spark):
    with tracked() as paths:
        base = registry._base(spark, SMALL)
    assert len(_left(paths)) == 1 and base.count() > 0
    with tracked() as paths:
        level = chains.overlap_level(base)
    assert level.count() > 0 and not {"signatures", "signed_rows"} & set(_left(paths))


def test_signatures_meet_whole_rows_once(spark, monkeypatch):
    base, joins = registry._base(spark, SMALL), []
    monkeypatch.setattr(hubs, "materialize", lambda df, name: joins.append(name) or materialize(df, name))
    hubs.surviving_pairs(base).count()
    assert joins == ["signatures", "signed_rows"]


def test_chain_table_leaves_its_own_folder_only(spark, tmp_path):
    base, path = registry._base(spark, SMALL), str(tmp_path / "table")
    with tracked() as paths:
        chain_table.create(base, 2, path)
        rows = base.limit(3)
        chain_table.apply_changes(spark, path, rows, rows.select(F.get(F.col("chain"), 0).alias("numctr")), 2)
    assert _left(paths) == ["changed"]
    assert chain_table.chain_rows(spark, path, base).count() == chains.build(base, 2).count()
