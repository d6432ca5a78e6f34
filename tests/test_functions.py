import datetime as dt

from pyspark.sql import functions as F

from rightsweave.functions import arrays as A


def test_restriction_void_truth_table(spark):
    df = spark.createDataFrame([([], []), (["X"], []), ([], ["X"]), (["X", "Y"], ["Y", "Z"]), (["X"], ["Z"])],
                               "a array<string>, b array<string>")
    got = [(r.v, list(r.m)) for r in df.select(A.restriction_void("a", "b").alias("v"),
                                               A.restriction_meet("a", "b").alias("m")).collect()]
    assert got == [(False, []), (True, []), (True, []), (False, ["Y"]), (True, [])]


def test_date_combination_with_open_ends(spark):
    D = dt.date
    df = spark.createDataFrame([
        (D(2000, 1, 1), None, D(2001, 6, 1), D(2010, 1, 1)),
        (D(2002, 1, 1), D(2005, 1, 1), D(2001, 1, 1), None),
        (D(2002, 1, 1), D(2005, 1, 1), None, D(2004, 1, 1)),
    ], "s1 date, e1 date, s2 date, e2 date")
    got = [(r.s, r.e) for r in df.select(A.later_start("s1", "s2").alias("s"),
                                         A.earlier_end("e1", "e2").alias("e")).collect()]
    assert got == [(D(2001, 6, 1), None), (D(2002, 1, 1), D(2005, 1, 1)), (D(2002, 1, 1), D(2004, 1, 1))]


def test_truncated_percent_product_and_sizes(spark):
    df = spark.createDataFrame([(75.0, 50.0), (33.0, 33.0), (None, 10.0)], "x double, y double")
    got = [r[0] for r in df.select(A.truncated_pct_product("x", "y")).collect()]
    assert got == [37.0, 10.0, None]
    s = spark.createDataFrame([([1, 2],), (None,)], "a array<int>")
    assert [r[0] for r in s.select(A.safe_size("a")).collect()] == [2, -1]


def test_set_helpers_and_text_keys(spark):
    df = spark.createDataFrame([([3, 1, 1], [2, 3])], "a array<int>, b array<int>")
    r = df.select(A.set_union("a", "b").alias("u"), A.set_intersect("a", "b").alias("i"),
                  A.key_string(A.as_set("a")).alias("k"), A.key_string("a").alias("t"),
                  A.flatten_or_empty(F.lit(None).cast("array<array<int>>"), "int").alias("f")).collect()[0]
    assert list(r.u) == [1, 2, 3] and list(r.i) == [3] and r.k == "1|3" and r.t == "3|1|1" and list(r.f) == []
