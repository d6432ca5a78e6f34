import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from rightsweave.functions.arrays import key_string
from rightsweave.plans import chains

CHAIN_DDL = (
    "chain array<int>, "
    "assignors array<struct<catalog:bigint,role:string,pct_publisher:double,pct_creator:double,"
    "right_types:array<string>>>, "
    "assignees array<struct<catalog:bigint,role:string,manager:int>>, "
    "contract_type string, start_date date, end_date date, assignable int, biem int, idtercess int, "
    "fledit int, genre_incl array<string>, genre_excl array<string>, catalog_incl array<bigint>, "
    "catalog_excl array<bigint>, work_incl array<bigint>, work_excl array<bigint>, territories array<int>"
)


def contract(num, assignor_cats, assignee_cats, assignable=1, role="E", pct=100.0, start=None, end=None,
             genre_incl=(), work_excl=(), territories=(1, 2, 3), assignor_pcts=None):
    pcts = assignor_pcts or [pct] * len(assignor_cats)
    return (
        [num],
        [(c, role, p, 0.0, ["DE"]) for c, p in zip(assignor_cats, pcts)],
        [(c, "SE", 0) for c in assignee_cats],
        "GENERAL", start or dt.date(2000, 1, 1), end, assignable, 1, 0, 0,
        list(genre_incl), [], [], [], [], list(work_excl), list(territories),
    )


def chain_keys(df):
    return sorted(r[0] for r in df.select(key_string("chain")).collect())


def test_overlap_chain_levels(spark):
    base = spark.createDataFrame([
        contract(1, [100], [200, 201]), contract(2, [201], [300]),
        contract(3, [300], [400]), contract(4, [201], [500]),
    ], CHAIN_DDL)
    lv = chains.levels(base, 3)
    assert chain_keys(lv[1]) == ["1|2", "1|4", "2|3"]
    assert chain_keys(lv[2]) == ["1|2|3"]
    assert chain_keys(lv[3]) == []
    built = chains.build(base, 3)
    assert chain_keys(built) == ["1", "1|2", "1|2|3", "1|4", "2", "2|3", "3", "4"]


def test_not_assignable_stops_the_chain(spark):
    base = spark.createDataFrame([
        contract(1, [100], [200, 201]), contract(2, [201], [300], assignable=0),
        contract(3, [300], [400]), contract(4, [201], [500]),
    ], CHAIN_DDL)
    lv = chains.levels(base, 3)
    assert chain_keys(lv[1]) == ["1|2", "1|4"]
    assert chain_keys(lv[2]) == []


def test_pivot_mode_merges_on_pivot_only(spark):
    # [a,b,c] and [b,x,y] merge to [a,b,c,x,y] at depth 2 (only the pivot is compared)
    base = spark.createDataFrame([
        contract(1, [10], [20]), contract(2, [20], [30, 40]), contract(3, [30], [99]),
        contract(4, [40], [50]), contract(5, [50], [98]),
    ], CHAIN_DDL)
    lv = chains.levels(base, 2)
    assert chain_keys(lv[1]) == ["1|2", "2|3", "2|4", "4|5"]
    assert chain_keys(lv[2]) == ["1|2|3", "1|2|4", "2|4|5"]
    paths = chains.paths(base, 3)
    assert "1|2|4|5" in chain_keys(paths)


def test_dates_percent_and_restrictions(spark):
    base = spark.createDataFrame([
        contract(1, [100], [200], start=dt.date(2000, 1, 1), end=None, pct=75.0),
        contract(2, [200], [300], start=dt.date(2001, 6, 1), end=dt.date(2010, 1, 1), pct=50.0),
    ], CHAIN_DDL)
    r = chains.overlap_level(chains.with_row_id(base)).collect()[0]
    assert (r.start_date, r.end_date) == (dt.date(2001, 6, 1), None)
    assert [a.pct_publisher for a in r.assignors] == [37.0]


def test_percent_other_role_and_shorter_list(spark):
    other = spark.createDataFrame([
        contract(1, [100], [200], pct=75.0), contract(2, [200], [300], role="A", pct=50.0),
    ], CHAIN_DDL)
    r = chains.overlap_level(chains.with_row_id(other)).collect()[0]
    assert [a.pct_publisher for a in r.assignors] == [75.0]
    shorter = spark.createDataFrame([
        contract(1, [100, 101], [200], assignor_pcts=[75.0, 75.0]), contract(2, [200], [300], pct=50.0),
    ], CHAIN_DDL)
    r = chains.overlap_level(chains.with_row_id(shorter)).collect()[0]
    assert [a.pct_publisher for a in r.assignors] == [37.0, None]


def test_restriction_meet_voids(spark):
    cases = [((), (), True, []), (("X",), (), False, None), (("X", "Y"), ("Y", "Z"), True, ["Y"]),
             (("X",), ("Z",), False, None)]
    for a, b, kept, expected in cases:
        base = spark.createDataFrame([
            contract(1, [100], [200], genre_incl=a), contract(2, [200], [300], genre_incl=b),
        ], CHAIN_DDL)
        out = chains.overlap_level(chains.with_row_id(base)).collect()
        assert bool(out) == kept, (a, b)
        if kept:
            assert list(out[0].genre_incl) == expected


def test_empty_territory_intersection_voids(spark):
    base = spark.createDataFrame([
        contract(1, [100], [200], territories=(1,)), contract(2, [200], [300], territories=(2,)),
    ], CHAIN_DDL)
    assert chains.overlap_level(chains.with_row_id(base)).count() == 0


def test_flatten_fans_out(spark):
    c = contract(1, [100, 101], [200, 201])
    base = spark.createDataFrame([c], CHAIN_DDL).withColumn(
        "assignors", F.transform("assignors", lambda x: x.withField("right_types", F.array(F.lit("DE"), F.lit("DR")))))
    flat = chains.flatten(base)
    assert flat.count() == 2 * 2 * 2
    assert rows(flat.select("assignor_catalog").distinct()) == [(100,), (101,)]


def test_overlap_reach(spark):
    base = spark.createDataFrame([
        contract(1, [10], [20]), contract(2, [20], [30]), contract(3, [30], [40]), contract(4, [40], [10]),
    ], CHAIN_DDL)
    reach = {(r.from_ctr, r.to_ctr): r.hops for r in chains.overlap_reach(base).collect()}
    assert reach[(1, 2)] == 1 and reach[(1, 3)] == 2 and reach[(1, 4)] == 3 and reach[(1, 1)] == 4
    assert len(reach) == 16


def test_overlap_reach_goes_to_the_end(spark):
    n = 23
    base = spark.createDataFrame([contract(i, [i], [i + 1]) for i in range(n)], CHAIN_DDL)
    reach = {(r.from_ctr, r.to_ctr): r.hops for r in chains.overlap_reach(base).collect()}
    assert reach == {(i, j): j - i for i in range(n) for j in range(i + 1, n)}
    ends = {(r.from_ctr, r.to_ctr): (r.assignor_catalogs, r.assignee_catalogs) for r in chains.reach_ends(base).collect()}
    assert ends[(0, n - 1)] == ([0], [n])


def test_row_ids_are_never_shared(spark):
    # the same values under another column, and null dates on either side
    rows_ = [contract(1, [100], [200], genre_incl=("X",)), contract(1, [100], [200])]
    rows_.append((*rows_[1][:11], ["X"], *rows_[1][12:]))
    rows_.append((*rows_[1][:4], None, dt.date(2000, 1, 1), *rows_[1][6:]))
    base = chains.with_row_id(spark.createDataFrame(rows_ + rows_[:2], CHAIN_DDL))
    assert base.count() == 4 and base.select("rid").distinct().count() == 4


def test_doubling_keeps_rows_with_alike_arrays_apart(spark):
    df = spark.createDataFrame([([1], [10, 20], [30]), ([1], [10], [20, 30]), ([2], [20], [40])],
                               "chain array<int>, cedant array<bigint>, cess array<bigint>")
    got = {(tuple(r.chain), tuple(r.cedant), tuple(r.cess)) for r in chains.doubling_rounds(df, 1).collect()}
    # only ([1], [10], [20, 30]) meets ([1], [10, 20], [30]) and ([2], [20], [40])
    assert got - {((1,), (10, 20), (30,)), ((1,), (10,), (20, 30)), ((2,), (20,), (40,))} == {
        ((1,), (10,), (30,)), ((1, 2), (10,), (40,))}


def test_older_scalar_levels(spark):
    from rightsweave.plans.contracts import SCALAR_COLUMNS
    ddl = ("chain array<int>, informants array<int>, contract_type string, assignable int, biem int, idtercess int, fledit int, "
           "start_date date, end_date date, assignor_person long, assignor_catalog long, assignor_role string, right_type string, "
           "pct_publisher double, pct_creator double, assignee_person long, assignee_catalog long, assignee_role string, "
           "genre_incl array<string>, genre_excl array<string>, catalog_incl array<long>, catalog_excl array<long>, "
           "work_incl array<long>, work_excl array<long>, requirements array<string>, territories array<int>")

    def row(n, frm, to, pct, asked, countries):
        return ([n], [n * 10], "GENERAL", 1, 1, 0, 0, dt.date(2000, 1, n), None, 1, frm, "E", "DE", pct, 0.0, 2, to, "SE",
                [], [], [7], [], [], [], asked, countries)

    base = spark.createDataFrame([row(1, 100, 200, 75.0, ["INFO"], [1, 2]), row(2, 200, 300, 50.0, ["STRICTE"], [2, 3]),
                                  row(3, 300, 400, 25.0, [], [2])], ddl)
    got = {(r.level, tuple(r.chain)): r for r in chains.scalar_levels(base, 3).collect()}
    assert set(got) == {(0, (1,)), (0, (2,)), (0, (3,)), (1, (1, 2)), (1, (2, 3)), (2, (1, 2, 3))}
    whole = got[(2, (1, 2, 3))]
    # [1, 2] is pivoted on its last contract: the percent is that of 1|2 times that of 2|3
    assert whole.pct_publisher == 75.0 * 50 / 100 * (50.0 * 25 / 100) / 100 and whole.requirements == ["INFO", "STRICTE"]
    assert whole.informants == [10, 20, 30] and whole.territories == [2] and whole.start_date == dt.date(2000, 1, 3)
    assert list(base.columns) == list(SCALAR_COLUMNS)


def test_doubling_rounds(spark):
    df = spark.createDataFrame([
        ([1], [10], [20, 21]), ([2], [21], [30]), ([3], [40], [50]), ([4], [30], [60]), ([5], [60], [70]),
    ], "chain array<int>, cedant array<bigint>, cess array<bigint>")
    out = chains.doubling_rounds(df, 3)
    got = sorted((tuple(r.chain), tuple(r.cedant), tuple(r.cess)) for r in out.collect())
    assert got == sorted([
        ((1,), (10,), (20, 21)), ((2,), (21,), (30,)), ((3,), (40,), (50,)), ((4,), (30,), (60,)),
        ((5,), (60,), (70,)),
        ((1, 2), (10,), (30,)), ((2, 4), (21,), (60,)), ((4, 5), (30,), (70,)),
        ((1, 2, 4, 5), (10,), (70,)),
    ])


def test_legacy_rules_unite_inclusive_and_keep_void(spark):
    base = spark.createDataFrame([
        contract(1, [100], [200], genre_incl=("X",), pct=75.0),
        contract(2, [200], [300], genre_incl=("Z",), pct=50.0, territories=(9,)),
    ], CHAIN_DDL)
    assert chains.overlap_level(chains.with_row_id(base)).count() == 0  # void and no territory
    r = chains.overlap_level(chains.with_row_id(base), legacy=True).collect()[0]
    assert list(r.genre_incl) == ["X", "Z"] and list(r.territories) == []
    assert [a.pct_publisher for a in r.assignors] == [37.5]  # not truncated


def test_paths_refuse_repeats_in_cycles(spark):
    base = spark.createDataFrame([
        contract(1, [10], [20]), contract(2, [20], [10]),
    ], CHAIN_DDL)
    assert chain_keys(chains.paths(base, 3)) == ["1", "1|2", "2", "2|1"]


def test_overlap_join_plans_no_nested_loop(spark):
    base = spark.createDataFrame([contract(i, [i], [i + 1]) for i in range(1, 30)], CHAIN_DDL)
    pairs = chains.overlap_pairs(chains.with_row_id(base))
    assert pairs.count() == 28
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
