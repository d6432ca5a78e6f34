import functools
import importlib

import pytest

from rightsweave import oracle, registry

SF = "/root/testdata/sf0.001"


def test_entry_contract(spark):
    E = importlib.import_module("__spark_entry__")
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 40
    df = E.entry(spark)
    assert df.columns == ["ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine",
                          "numcatal_ayant_droit_final", "role_ad_final", "chaine_contrats", "cle"]
    assert df.count() > 0


CORE = sorted(registry.QUERIES)


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """The contract base and the restitution inputs are assembled once for all queries of this module."""
    patch = pytest.MonkeyPatch()
    for name in ("_base", "_restitution_inputs", "_scalar_base"):
        patch.setattr(registry, name, functools.cache(getattr(registry, name)))
    yield
    patch.undo()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cur = duck.execute(oracle.oracle_queries()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)

    def same(rows):
        return sorted(rows, key=lambda t: tuple((x is not None, str(x)) for x in t))

    assert same(tuple(r[c] for c in cols) for r in df.collect()) == same(cur.fetchall())


def test_date_filter_reaches_the_scan(spark):
    df = registry.flt_contract_validity(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(o_orderdate" in plan


def test_worlds_of_two_folders_do_not_mix(spark):
    from rightsweave.sources import world as W
    small = W.load_world(spark, "/root/testdata/sf0.001")
    big = W.load_world(spark, "/root/testdata/sf0.01")
    assert small["contrat"].count() == 1500 and big["contrat"].count() == 15000


def test_planning_the_contract_tables_opens_each_file_once(spark):
    from rightsweave.sources import world as W
    from rightsweave.sources.schemas import CHAIN_TABLES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-world", "")
    t = W.load_world(spark, SF)
    for name in CHAIN_TABLES:
        t[name].schema  # noqa: B018
    assert len(tracker.getJobIdsForGroup("plan-world")) <= 7
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_submitted_session_keeps_its_settings(spark):
    from rightsweave.session import build_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    assert build_session().conf.get("spark.sql.shuffle.partitions") == "37"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_queries_without_the_llm_subpackage():
    """The entry module imports and offers the other queries when the llm folders are gone."""
    import subprocess
    import sys
    code = ("import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('rightsweave.llm', 'corpus_pipeline'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\n"
            "assert len(e.queries()) >= 60 and set(e.oracle_sql()) == set(e.queries())\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=importlib.import_module("os").path.dirname(
        importlib.import_module("__spark_entry__").__file__), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
