import random

from helpers import rows
from pyspark.sql import functions as F
from test_chains import CHAIN_DDL, contract

from rightsweave.plans import chains, hubs


def hub_world(n=90, seed=5):
    """A third of the contracts assign to catalog 1 and a third receive from it; few of those pairs survive."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        row = list(contract(i, [1] if i % 3 == 1 else [100 + i, 1000 + rnd.randrange(20)],
                            [1, 2] if i % 3 == 0 else [1000 + rnd.randrange(20), 2],
                            assignable=int(rnd.random() < 0.9), territories=rnd.sample(range(40), rnd.randrange(0, 4)),
                            genre_incl=rnd.choice([(), (), ("X",), ("X", "Y"), ("Y",)])))
        row[12] = rnd.choice([[], [], [7], [7, 8], [9]])  # inclusive catalogs
        row[14] = rnd.choice([[], [], [1, 2], [2, 3], [4]])  # inclusive works
        out.append(tuple(row))
    nulls = list(contract(n, [1], [1]))
    nulls[10] = None
    no_territory = list(contract(n + 1, [1], [1]))
    no_territory[16] = None
    no_lists = list(contract(n + 2, [1], [1]))
    no_lists[1] = no_lists[2] = None
    return [*out, tuple(nulls), tuple(no_territory), tuple(no_lists)]


def plain_pairs(base, right=None):
    """Every overlapping pair formed first, void ones dropped afterwards."""
    sides = chains.overlap_sides(base, right=right)
    made = sides.select("a_rid", "b_rid", *chains.combine())
    return made.where(~F.col("_void") & (F.size("territories") > 0)).select("a_rid", "b_rid").distinct()


def test_pairs_of_a_hub_equal_the_plain_join(spark):
    base = chains.with_row_id(spark.createDataFrame(hub_world(), CHAIN_DDL))
    found = rows(hubs.surviving_pairs(base))
    assert found == rows(plain_pairs(base)) and found
    assert len(found) < chains.overlap_pairs(base).count() / 5


def test_rows_formed_follow_the_survivors(spark):
    # no country is common: the hub has 30 x 30 pairs, none is formed, whatever their signatures are
    left = [contract(i, [10_000 + i], [1], territories=[i % 3]) for i in range(30)]
    right = [contract(100 + i, [1], [20_000 + i], territories=[50 + i % 3]) for i in range(30)]
    base = chains.with_row_id(spark.createDataFrame(left + right, CHAIN_DDL))
    signatures = hubs._signatures(base)
    assert signatures.count() == 6
    a = hubs._members(base, signatures, "assignees.catalog", ())
    b = hubs._members(base, signatures, "assignors.catalog", ())
    assert hubs.live_entries(a, b, signatures, ()).count() == 0
    assert hubs.surviving_pairs(base).count() == 0 and chains.overlap_pairs(base).count() == 900


def test_other_right_side_keys_and_no_rows(spark):
    base = chains.with_row_id(spark.createDataFrame(hub_world(seed=8), CHAIN_DDL))
    right = base.where("rid % 2 = 0")
    assert rows(hubs.surviving_pairs(base, right=right)) == rows(plain_pairs(base, right))
    keyed = base.withColumn("segment", F.element_at("chain", 1) % 2)
    want = [r for r in rows(plain_pairs(base).join(keyed.select(F.col("rid").alias("a_rid"), F.col("segment").alias("s")), "a_rid")
                            .join(keyed.select(F.col("rid").alias("b_rid"), F.col("segment").alias("t")), "b_rid")
                            .where("s = t"), "a_rid", "b_rid")]
    assert rows(hubs.surviving_pairs(keyed, ("segment",))) == want
    assert hubs.surviving_pairs(base.limit(0)).count() == 0


def test_level_keeps_its_rows(spark):
    base = spark.createDataFrame(hub_world(seed=3), CHAIN_DDL)
    plain = chains.keep_valid(chains.combined(chains.overlap_sides(base)))
    text = lambda df: sorted(str(r) for r in df.collect())
    assert text(chains.overlap_level(base)) == text(plain)
