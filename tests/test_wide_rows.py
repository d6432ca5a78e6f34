"""Whole rows are shuffled as seldom as possible, and no task lists all leaves."""
from pyspark.sql import functions as F

from rightsweave.plans import contracts, restitution, territories
from rightsweave.sources import world

SMALL = "/root/testdata/sf0.001"


def _nodes(df):
    """Nodes of the optimized plan: name, its columns, and the node."""
    found, left = [], [df._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop()
        found.append((node.nodeName(), node.output().mkString(","), node))
        left += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_elements_of_one_territory_are_dealt_out(spark):
    elements = spark.range(400).select(F.col("id").cast("int").alias("idtercmplx"), F.lit(9).alias("cdepaysiso4n"),
                                       F.lit(1).alias("incl"), F.lit(1.0).cast("float").alias("ord_list"))
    sets = spark.createDataFrame([(9, list(range(25)))], "cdepaysiso4n int, cdepaysiso4n_fils array<int>")
    rows = territories._element_leaves(elements, sets)
    held = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 10_000
    assert max(r["count"] for r in held) < 5_000
    assert territories.fold(elements, sets).count() == 400


def test_distinct_rows_shuffles_only_rows_with_equal_hashes(spark):
    from rightsweave.operators.distinct import distinct_rows

    rows = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (1, None), (1, None), (2, [1, 2]), (0, [])],
                                 "a int, b array<int>")
    out = distinct_rows(rows, "rows")
    assert out.columns == ["a", "b"]
    assert sorted(map(str, out.collect())) == sorted(map(str, rows.distinct().collect()))
    aggregates = [n for name, _, n in _nodes(out) if name == "Aggregate"]
    assert aggregates and all("LeftSemi" in n.toString() for n in aggregates)


def test_shares_join_whole_rows_once(spark):
    d = spark.createDataFrame(
        [(1, "A", 5, "E", 6, "SE", [10], 50.0, 0.0, 20.0, 1), (1, "A", 5, "E", 7, "SE", None, None, None, 30.0, 0),
         (1, None, 8, "CA", 8, "CA", [11], 25.0, 50.0, 10.0, 1)],
        "ide12 long, lettrage string, numcatal_cedant_origine long, role_ad_origine string, "
        "numcatal_ayant_droit_final long, role_ad_final string, chaine_contrats array<int>, pct_editeur double, "
        "pct_createur double, cle double, gestnr int")
    out = restitution.shares(d)
    joins = [n for name, columns, n in _nodes(out) if name == "Join" and "chaine_contrats" in columns]
    assert len(joins) == 1
    got = {(r.numcatal_ayant_droit_final, r.pct_cede, r.pct_restant, r.pct_final, r._group_cle) for r in out.collect()}
    assert got == {(6, 10.0, 10.0, 25.0, 50.0), (7, 15.0, 15.0, 15.0, 50.0), (8, 0.0, 10.0, None, 10.0)}


def test_contract_base_gathers_its_lists_in_one_aggregation(spark):
    tables = world.load_world(spark, SMALL)
    sets = spark.createDataFrame([], "idtercmplx int, territoires array<int>")
    base = contracts.contract_base(tables, sets, world.CONSULT_DATE)
    gathered = [n for name, _, n in _nodes(base) if name == "Aggregate" and "collect_set" in n.verboseString(10_000)
                and "Aggregate [idctr" in n.verboseString(10_000)]
    assert len(gathered) == 1


def test_contract_base_keeps_contracts_whose_restrictions_name_nothing(spark):
    restrctr = spark.createDataFrame([(1, 7, 1), (2, 7, 0), (3, 8, 1), (4, 9, None)], "idrestctr long, idctr long, additif int")
    genre = spark.createDataFrame([(1, "R"), (1, "R"), (2, None), (4, "N")], "idrestctr long, cdegreoeuv string")
    work = spark.createDataFrame([(2, 5), (2, 4)], "idrestctr long, ide12 long")
    pers = spark.createDataFrame([(1, 11, "STRICTE"), (1, 12, "INFO")], "idrestctr long, numcatal long, cdeexignc string")
    got = {r["idctr"]: tuple(r)[1:] for r in contracts.restrictions(restrctr, genre, work, pers).collect()}
    assert got == {7: (["R"], [], [11], [], [], [4, 5]), 8: ([], [], [], [], [], []), 9: ([], [], [], [], [], [])}
    loose = contracts.restrictions(restrctr, genre, work, pers, strict_catalogs=False).where("idctr = 7").collect()
    assert loose[0]["catalog_incl"] == [11, 12]


def test_static_keys_join_the_countries_to_distinct_rows_only(spark):
    tables = world.load_world(spark, SMALL)
    sets = spark.createDataFrame([(i, [3, i + 100]) for i in range(150)], "idtercmplx int, territoires array<int>")
    requests = restitution.single_request(tables["oeuv"].select("ide12"), 3, "DE", world.CONSULT_DATE)
    keys = restitution.static_keys(tables, sets.unionByName(sets), requests)
    wide = [n for name, columns, n in _nodes(keys) if name == "Join" and "territoires" in columns]
    assert len(wide) == 1
    plain = restitution.static_keys(tables, sets, requests, keep_territories=False)
    assert keys.columns == [*plain.columns[:13], "territoires", *plain.columns[13:]]
    assert keys.count() == plain.count() == plain.distinct().count() > 1000
    assert not any(name == "Aggregate" and "LeftSemi" not in n.toString() for name, _, n in _nodes(plain))
    assert restitution.static_keys(tables, sets.where("idtercmplx < 0"), requests).count() == 0


def test_only_longest_chains_meet_owner_rows(spark, monkeypatch):
    """The filter made before matching keeps what the filter over all matches keeps, and writes no other matches."""
    import random

    rnd = random.Random(5)
    flat = spark.createDataFrame(
        [([rnd.choice((None, 1, 2, 3, 4)), *range(rnd.randrange(4))], rnd.choice((901, 902, 903, None)), rnd.choice("EA"), 950,
          "SE", 50.0, 0.0, rnd.choice(("DE", "DR")), [3, 4][:rnd.randrange(3)], [7]) for _ in range(60)],
        "chain array<int>, assignor_catalog long, assignor_role string, assignee_catalog long, assignee_role string, "
        "pct_publisher double, pct_creator double, right_type string, territories array<int>, work_excl array<long>")
    owners = [(q, rnd.randrange(6), rnd.choice(("A", None)), rnd.choice((901, 902, 904, None)), float(i), "E", 1,
               rnd.choice((100, 101, None))) for i in range(120) for q in (1, 2, None)]
    ddl = ("num_contexte int, ide12 long, let string, numcatal long, cle double, cdecategadsacem string, gestnr int, "
           "priort long, cdetypdrtsacem string, code_iso4n_pays int")
    single = spark.createDataFrame([(*o, "DE" if o[0] == 1 else "DR", 3 if o[0] == 2 else 4) for o in owners], ddl)
    mixed = spark.createDataFrame([(*o, rnd.choice(("DE", "DR")), rnd.choice((3, 4))) for o in owners], ddl)
    written = []
    for keys, request_keys, strict in ((single, ["num_contexte"], False), (single, ["num_contexte"], True),
                                       (mixed, [], False), (mixed, ["num_contexte"], True)):
        rows = restitution.owner_chains(keys, flat).select(
            *request_keys, "ide12", F.col("let").alias("lettrage"), F.col("numcatal").alias("numcatal_cedant_origine"),
            F.coalesce("assignor_role", "cdecategadsacem").alias("role_ad_origine"),
            F.coalesce("assignee_catalog", "numcatal").alias("numcatal_ayant_droit_final"),
            F.coalesce("assignee_role", "cdecategadsacem").alias("role_ad_final"), F.col("chain").alias("chaine_contrats"),
            F.col("pct_publisher").alias("pct_editeur"), F.col("pct_creator").alias("pct_createur"),
            "cle", "priort", "gestnr", "work_excl")
        all_first = restitution.longest_chains(rows, request_keys, strict)
        want = sorted(map(str, all_first.collect()))
        with monkeypatch.context() as m:
            m.setattr(restitution, "materialize", lambda df, name, real=restitution.materialize: written.append(
                (name, keys is mixed and strict)) or real(df, name))
            got = restitution.match_chains(keys, flat, request_keys, strict)
        assert got.columns == all_first.columns
        assert sorted(map(str, got.collect())) == want and len(want) > 10
    assert ("matched", False) not in written and ("longest", False) in written


def test_owner_rows_of_both_joins_share_one_shuffle(spark):
    flat = spark.createDataFrame([([7], 901, "E", 950, "SE", 75.0, 0.0, "DE", [250, 1])],
        "chain array<int>, assignor_catalog long, assignor_role string, assignee_catalog long, assignee_role string, "
        "pct_publisher double, pct_creator double, right_type string, territories array<int>")
    keys = spark.createDataFrame([(1, c, "DE", 250) for c in (901, 902, None)],
                                 "ide12 long, numcatal long, cdetypdrtsacem string, code_iso4n_pays int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = restitution.owner_chains(keys, flat)
        got = sorted((str(r.numcatal), r.assignee_catalog) for r in joined.collect())
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == [("901", 950), ("902", None), ("None", None)]
    assert "ReusedExchange" in plan


def test_repeated_hashes_are_told_by_a_map_of_fixed_size(spark, monkeypatch):
    """However many rows repeat, the rows of a hash of their own are not shuffled."""
    from rightsweave.operators import distinct

    monkeypatch.setattr(distinct, "MAP_WORDS", 64, raising=False)
    rows = spark.range(3000).select((F.col("id") % 2900).alias("a"), F.array(F.col("id") % 2900).alias("b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        out = distinct.distinct_rows(rows, "rows")
        assert sorted(r["a"] for r in out.collect()) == list(range(2900))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_rows_without_repeats_are_read_as_written(spark):
    from rightsweave.operators.distinct import distinct_rows

    out = distinct_rows(spark.range(500).select("id", F.array("id").alias("b")), "rows")
    assert out.columns == ["id", "b"] and out.count() == 500
    assert {name for name, _, _ in _nodes(out)} <= {"Project", "LogicalRelation"}


def test_rows_with_an_id_are_written_once_unless_they_repeat(spark, monkeypatch):
    from rightsweave.operators import distinct
    from rightsweave.plans import chains

    tables = world.load_world(spark, SMALL)
    sets = spark.createDataFrame([(i, [3, 1, 3, None]) for i in range(150)], "idtercmplx int, territoires array<int>")
    base = contracts.contract_base(tables, sets, world.CONSULT_DATE)
    written = []
    for module in (distinct, chains):
        monkeypatch.setattr(module, "materialize", lambda df, name, real=distinct.materialize: written.append(
            (name, len(df.columns))) or real(df, name))
    once = chains.with_row_id(base)
    assert [name for name, columns in written if columns > 2] == ["base_rows"]
    assert once.columns == [*contracts.CHAIN_COLUMNS, "rid"]
    twice = chains.with_row_id(base.unionByName(base.where("contract_type = 'ADMIN'")))
    for rows in (once, twice):
        assert rows.count() == rows.select("rid").distinct().count() == rows.drop("rid").distinct().count() > 300
    assert sorted(map(str, once.drop("rid").collect())) == sorted(map(str, twice.drop("rid").collect()))
    assert all(r["territories"] == [1, 3, None] for r in once.select("territories").collect())


def test_rows_of_several_levels_are_found_without_reading_their_lists(spark):
    from rightsweave.operators import distinct
    from rightsweave.plans import chains

    ddl = "chain array<int>, assignable int, territories array<int>"
    parts = [spark.createDataFrame(rows, ddl) for rows in (
        [([1], 1, [3]), ([2], 1, [3])], [([1, 2], 1, [3]), ([1], 1, [3]), ([1], 1, [4]), ([2], 0, [3]), (None, 1, [3])])]
    parts = [distinct.materialize(p, "part") for p in parts]
    out = chains.union_levels(parts)
    want = parts[0].union(parts[1]).distinct()
    assert out.count() == 6 and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    hashes = [n.toString() for name, _, n in _nodes(out) if name == "Project" and "xxhash64" in n.toString()]
    assert hashes and not any("territories" in h[h.index("xxhash64("):].split(")")[0] for h in hashes)


def test_contract_base_has_one_buffer_for_all_restriction_sets(spark):
    tables = world.load_world(spark, SMALL)
    sets = spark.createDataFrame([], "idtercmplx int, territoires array<int>")
    base = contracts.contract_base(tables, sets, world.CONSULT_DATE)
    gathered = [n.verboseString(10_000) for name, _, n in _nodes(base) if name == "Aggregate"]
    assert sum(x.count("collect_set(") for x in gathered) == 3
