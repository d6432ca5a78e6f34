import random

from helpers import rows

from rightsweave.plans import territories as T

EDGE_SCHEMA = "cdepaysiso4npere int, cdepaysiso4nfils int"
ELT_SCHEMA = "idtercmplx int, cdepaysiso4n int, incl int, ord_list float"


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, EDGE_SCHEMA)


HIERARCHY = [(90, 10), (90, 11), (10, 1), (10, 2), (11, 3)]


def test_closure_and_leaf_sets(spark):
    e = _edges(spark, HIERARCHY)
    pairs = rows(T.closure(e), "ancestor", "descendant")
    assert pairs == sorted(HIERARCHY + [(90, 1), (90, 2), (90, 3)])
    sets = {r.cdepaysiso4n: list(r.cdepaysiso4n_fils) for r in T.leaf_sets(e).collect()}
    assert sets == {90: [1, 2, 3], 10: [1, 2], 11: [3], 1: [1], 2: [2], 3: [3]}


def test_closure_is_idempotent_and_cycle_safe(spark):
    e = _edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4)])
    once = T.closure(e)
    got = rows(once, "ancestor", "descendant")
    assert got == sorted({(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)})
    again = T.closure(once.withColumnRenamed("ancestor", "cdepaysiso4npere")
                      .withColumnRenamed("descendant", "cdepaysiso4nfils"))
    assert rows(again, "ancestor", "descendant") == got


def test_fold_cases(spark):
    sets = T.leaf_sets(_edges(spark, HIERARCHY))
    elements = spark.createDataFrame([
        (500, 90, 1, 1.0), (500, 10, 0, 2.0), (500, 2, 1, 3.0),   # {2, 3}
        (501, 10, 1, 1.0), (501, 90, 0, 2.0),                      # empty, row kept
        (502, 10, 0, 1.0), (502, 10, 1, 1.0),                      # tie: include sorts last
        (503, 77, 1, 1.0), (503, 11, 1, 2.0),                      # unknown territory dropped
    ], ELT_SCHEMA)
    expected = {500: [2, 3], 501: [], 502: [1, 2], 503: [3]}
    got = {r.idtercmplx: list(r.territoires) for r in T.fold(elements, sets).collect()}
    assert got == expected
    got_w = {r.idtercmplx: list(r.territoires) for r in T.fold_window(elements, sets).collect()}
    assert got_w == expected


def _brute_fold(elements, sets):
    out = {}
    by_id = {}
    for tid, terr, incl, order in elements:
        if terr in sets:
            by_id.setdefault(tid, []).append((order, incl, sets[terr]))
    for tid, steps in by_id.items():
        acc = set()
        for _, incl, leaves in sorted(steps):
            acc = acc | set(leaves) if incl else acc - set(leaves)
        out[tid] = sorted(acc)
    return out


def test_fold_matches_brute_force(spark):
    rnd = random.Random(7)
    hierarchy = [(100, 10), (100, 11), (100, 12), (10, 1), (10, 2), (11, 3), (11, 4), (12, 5), (12, 1)]
    e = _edges(spark, hierarchy)
    sets = {r.cdepaysiso4n: list(r.cdepaysiso4n_fils) for r in T.leaf_sets(e).collect()}
    territories = list(sets) + [999]
    elements = []
    for tid in range(40):
        for _ in range(rnd.randint(1, 6)):
            elements.append((tid, rnd.choice(territories), rnd.randint(0, 1), float(rnd.randint(1, 4))))
    edf = spark.createDataFrame(elements, ELT_SCHEMA)
    expected = _brute_fold(elements, sets)
    got = {r.idtercmplx: sorted(r.territoires) for r in T.fold(edf, T.leaf_sets(e)).collect()}
    assert got == expected
    got_w = {r.idtercmplx: sorted(r.territoires) for r in T.fold_window(edf, T.leaf_sets(e)).collect()}
    assert got_w == expected


def test_contains_country(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3]), (3, [])], "idtercmplx int, territoires array<int>")
    assert rows(T.contains_country(df, 2), "idtercmplx") == [(1,)]


def test_closure_of_a_deep_hierarchy(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "cdepaysiso4npere int, cdepaysiso4nfils int")
    assert T.closure(edges).count() == n * (n + 1) // 2
    ring = spark.createDataFrame([(i, (i + 1) % 9) for i in range(9)], "cdepaysiso4npere int, cdepaysiso4nfils int")
    assert T.closure(ring).count() == 81


def test_children_of_several_parts_meet_the_parents_in_one_join(spark):
    ddl = f"{T.PARENT} int, {T.CHILD} int"
    parts = [spark.createDataFrame([(9, p), (p, 100 + p), (p, 7), (None, 8), (8, None)], ddl) for p in (1, 2, 3)]
    edges = parts[0].unionByName(parts[1]).unionByName(parts[2])
    lv = T.leaves(edges)
    assert lv._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1
    assert rows(lv) == [(7,), (101,), (102,), (103,)]
    got = {r[0]: r[1] for r in T.leaf_sets(edges).collect()}
    assert got[9] == [7, 101, 102, 103] and got[1] == [7, 101] and got[7] == [7] and 8 not in got
