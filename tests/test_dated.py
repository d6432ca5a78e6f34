"""Date segments and the interval join behind them."""

import datetime as dt
import random

from helpers import rows
from pyspark.sql import functions as F

from rightsweave import registry
from rightsweave.plans import dated, jobs, restitution
from rightsweave.sources import world as W

DAY = dt.date(1990, 1, 1)


def test_intervals_and_days_share_one_node(spark):
    rng = random.Random(1)
    spans = [(i, a := rng.randrange(1 << dated.LEVELS), min(1 << dated.LEVELS, a + rng.choice([0, 1, 2, 30, 4000, 1 << 21]))) for i in range(60)]
    spans += [(60, 0, 1 << dated.LEVELS), (61, 5, 5), (62, 9, 3)]
    days = sorted({0, (1 << dated.LEVELS) - 1, *(d for _, a, b in spans for d in (a, b - 1, b, a - 1) if 0 <= d < 1 << dated.LEVELS)})
    left = spark.createDataFrame(spans, "i int, a int, b int").select("i", F.inline(dated.interval_nodes(F.col("a"), F.col("b"))))
    right = spark.createDataFrame([(d,) for d in days], "d int").select("d", F.inline(dated.day_nodes(F.col("d"))))
    got = rows(left.join(right, ["level", "node"]), "i", "d")
    assert got == sorted((i, d) for i, a, b in spans for d in days if a <= d < b)  # once each
    plan = left.join(right, ["level", "node"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_dates_of_a_segment_see_the_same_versions(spark):
    rng = random.Random(2)
    versions = [(i, DAY + dt.timedelta(rng.randrange(900)), None if rng.random() < 0.3 else DAY + dt.timedelta(rng.randrange(1200)))
                for i in range(80)] + [(80, None, DAY)]
    contrat = spark.createDataFrame(versions, "idctr int, datdbtsys date, datfinsys date")
    dates = sorted({DAY + dt.timedelta(rng.randrange(-30, 1300)) for _ in range(120)})
    requests = spark.createDataFrame([(d,) for d in [*dates, *dates, None]], "date_consultation date")
    segments = dated.date_segments(contrat, requests)
    of = {r.date_consultation: r.segment for r in segments.collect()}
    assert sorted(of) == dates

    def seen(day):
        return {i for i, a, b in versions if a is not None and a < day and (b is None or day < b)}

    by_segment = {}
    for day in dates:
        assert by_segment.setdefault(of[day], seen(day)) == seen(day)
    spread = dated.spread(contrat, segments)
    got = {}
    for r in spread.collect():
        got.setdefault(r.segment, set()).add(r.idctr)
    assert got == {s: ids for s, ids in by_segment.items() if ids}
    assert spread.count() == sum(map(len, got.values()))


def test_a_batch_over_dates_is_one_run_for_each(spark):
    t = registry._world(spark, "/root/testdata/sf0.001")
    dates = ["1995-05-05", "1997-01-20"]
    works = t["oeuv"].select("ide12")
    one = [restitution.single_request(works, W.COUNTRY, W.RIGHT_TYPE, d).withColumn("num_contexte", F.lit(i)) for i, d in enumerate(dates)]
    got = rows(restitution.as_text(dated.restitution_by_date(t, one[0].unionByName(one[1]), 2, ["num_contexte"])))
    want = []
    for i, d in enumerate(dates):
        want += rows(restitution.as_text(jobs.restitution_job(t, one[i], d, 2, ["num_contexte"])))
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r)) and len(got) > 1000
