import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from rightsweave.operators.joins import heavy_keys, salted_join
from rightsweave.operators.projections import prefix_columns, suffix_columns
from rightsweave.session import scratch_dir
from rightsweave.sources import io


def _path(spark, name):
    return f"{scratch_dir(spark)}/rightsweave-tests/{uuid.uuid4().hex}/{name}"


def test_schema_from_type_words():
    s = io.schema_from_words({"a": "long", "b": "string_optional", "c": "array_long", "d": "date"})
    assert [f.dataType.simpleString() for f in s.fields] == ["bigint", "string", "array<bigint>", "date"]
    assert [f.nullable for f in s.fields] == [True, False, True, True]
    with pytest.raises(ValueError):
        io.schema_from_words({"x": "decimal"})


def test_pipe_parse_with_blanks(spark):
    df = spark.createDataFrame([("1|2|3",), ("4 | 5",), ("6",), (None,)], "s string")
    got = [r[0] for r in df.select(io.parse_pipe_array("s").alias("a")).collect()]
    assert got == [[1, 2, 3], [4, 5], [6], None]


def test_expected_file_roundtrip(spark):
    df = spark.createDataFrame([(1, "A", 2, "E", 3, "SE", [7, 8], 37.5), (1, None, 2, "CA", 2, "CA", None, 50.0)],
                               "ide12 long, lettrage string, numcatal_cedant_origine long, role_ad_origine string, "
                               "numcatal_ayant_droit_final long, role_ad_final string, chaine_contrats array<int>, "
                               "cle double")
    path = _path(spark, "expected")
    io.write_expected(df, path)
    back = io.read_expected(spark, path)
    assert rows(back) == rows(df)


def test_partitioned_write_prunes(spark):
    df = spark.createDataFrame([(1, "DE"), (2, "DR"), (3, "DE")], "id long, right string")
    path = _path(spark, "parts")
    io.write_parquet(df, path, partition_by="right")
    q = spark.read.parquet(path).where(F.col("right") == "DE")
    assert rows(q, "id") == [(1,), (3,)]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "DE" in plan


def test_read_or_compute_and_registry(spark):
    path = _path(spark, "computed")
    calls = []

    def compute():
        calls.append(1)
        return spark.range(5).withColumn("v", F.col("id") * 2)

    a = io.read_or_compute(spark, path, compute)
    b = io.read_or_compute(spark, path, compute)
    assert len(calls) == 1 and rows(a) == rows(b)
    reg = {"t": {"path": path, "columns": ["v"]}}
    assert rows(io.read_registry(spark, reg)["t"]) == [(0,), (2,), (4,), (6,), (8,)]


def test_csv_to_parquet_appends(spark):
    csv = _path(spark, "in_csv")
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").write.option("header", True).csv(csv)
    out = _path(spark, "out_parquet")
    io.csv_to_parquet(spark, csv, out)
    back = io.csv_to_parquet(spark, csv, out)
    assert back.count() == 4 and dict(back.dtypes)["a"] == "string"


def test_dated_path():
    assert io.dated_path("s3://b/out/", "chains", 4, "2024-06-21") == "s3://b/out/chains_depth_4_2024-06-21"


def test_jdbc_options_only():
    opts = io.jdbc_options("jdbc:postgresql://db/x", "t", "u", "p")
    assert opts["dbtable"] == "t" and opts["fetchsize"] == "10000"


def test_salted_join_equals_plain(spark):
    big = spark.createDataFrame([(k % 3, i) for i, k in enumerate(range(200))], "k int, i int")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k int, s string")
    assert rows(salted_join(big, small, ["k"], 8)) == rows(big.join(small, ["k"]))
    assert rows(salted_join(big, small, ["k"], 8, "left")) == rows(big.join(small, ["k"], "left"))


def test_renaming_projections(spark):
    df = spark.createDataFrame([(1, 2, 3)], "idctr int, a int, b int")
    assert suffix_columns(df, "cedant", keep=("idctr",)).columns == ["idctr", "a_cedant", "b_cedant"]
    assert prefix_columns(df, "p").columns == ["p_idctr", "p_a", "p_b"]


def test_contract_base_of_day_reads_back(spark, tmp_path_factory):
    from rightsweave.plans import jobs
    from rightsweave.sources import world as W
    tables = W.load_world(spark, "/root/testdata/sf0.001")
    root = _path(spark, "bases")
    first = jobs.contract_base_of_day(tables, root, W.CONSULT_DATE)
    again = jobs.contract_base_of_day(tables, root, W.CONSULT_DATE)
    assert first.count() == again.count() > 0
    assert io.exists(spark, io.dated_path(root, "contract_base", 0, W.CONSULT_DATE))


def test_read_tables_csv_declared_schema_and_dedup(spark):
    root = _path(spark, "tables")
    import os
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/cess.csv", "w") as fh:
        fh.write("idcess,idtercmplx,priort\n1,5,100\n1,5,100\n2, ,101\n")
    with open(f"{root}/jeucle.csv", "w") as fh:
        fh.write("idjeucle,datdbtsys,cdetypdrtsacem\n7,2015-11-04 00:00:00.000000,DE\n")
    schemas = {"cess": {"idcess": "long", "idtercmplx": "integer", "priort": "long"},
               "jeucle": {"idjeucle": "long", "datdbtsys": "date", "cdetypdrtsacem": "string"}}
    t = io.read_tables(spark, root, ["cess", "jeucle"], schemas, file_type="csv", dedup=True)
    assert rows(t["cess"]) == [(1, 5, 100), (2, None, 101)]
    import datetime as dt
    assert rows(t["jeucle"]) == [(7, dt.date(2015, 11, 4), "DE")]
    inferred = io.read_csv(spark, f"{root}/cess.csv", infer=True)
    assert dict(inferred.dtypes)["idcess"] == "int"


def test_exists_wants_a_finished_write(spark):
    import os
    root = _path(spark, "marker")
    assert not io.exists(spark, root)
    os.makedirs(f"{root}/_temporary/0")
    assert not io.exists(spark, root)  # a write that was cut off
    spark.range(3).write.mode("overwrite").parquet(root)
    assert io.exists(spark, root)
    os.remove(f"{root}/_SUCCESS")
    with pytest.raises(RuntimeError):
        io.read_or_compute(spark, root, lambda: spark.range(1))
    assert spark.read.parquet(root).count() == 3


def test_tracked_intermediates_can_be_discarded(spark):
    from rightsweave.session import discard, materialize, tracked
    kept = materialize(spark.range(3), "kept")
    with tracked() as paths:
        inner = materialize(spark.range(5), "inner")
        assert inner.count() == 5
    materialize(spark.range(1), "outside")
    assert len(paths) == 1 and io.exists(spark, paths[0])
    discard(spark, paths)
    assert not io.exists(spark, paths[0]) and kept.count() == 3


def test_only_heavy_keys_are_salted(spark):
    # a third of the rows on one key, a thirtieth nulls, the rest on 400 keys
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 30 == 1, None)
                                   .otherwise(F.col("id") % 400).cast("int").alias("k"), F.col("id").alias("v"))
    small = spark.range(-1, 400).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    heavy = rows(heavy_keys(big, ["k"], 16))
    assert heavy == rows(spark.range(1).select(F.xxhash64(F.lit(-1)).alias("_key"), F.lit(6).alias("salts")))
    for how in ("inner", "left"):
        joined = salted_join(big, small, ["k"], 16, how)
        assert joined.columns == ["k", "v", "w"] and rows(joined) == rows(big.join(small, ["k"], how))
    assert rows(heavy_keys(big.limit(0), ["k"], 16)) == []
    assert salted_join(big.limit(0), small, ["k"]).count() == 0
    with pytest.raises(ValueError):
        salted_join(big, small.withColumn("k", F.col("k").cast("long")), ["k"])


def _text(spark, name, *lines):
    path = _path(spark, name)
    spark.createDataFrame([("\n".join(lines),)], "s string").coalesce(1).write.text(path)
    return path


def test_lines_that_do_not_fit_are_rejected_with_reasons(spark):
    columns = {"id": "integer", "name": "string", "day": "date", "pct": "double"}
    path = _text(spark, "table", "id,name,day,pct", "1,a,2001-02-03,1.5", "2,,,", '3,"x,y",2001-02-03,7', "4,b,2001-02-03",
                 "5,c,2001-02-03,1,9", "x,d,2001-02-03,oops", "7,e,2001-02-33,1", '8,"f,""g""",never,2')
    good, rejects = io.load_csv(spark, path, _path(spark, "typed"), columns)
    assert [r[0] for r in rows(good)] == [1, 2, 3] and good.schema["day"].dataType.simpleString() == "date"
    got = {r.line: r.reasons for r in rejects.collect()}
    assert got == {
        "4,b,2001-02-03": ["3 fields instead of 4"], "5,c,2001-02-03,1,9": ["5 fields instead of 4"],
        "x,d,2001-02-03,oops": ["id is not int", "pct is not double"], "7,e,2001-02-33,1": ["day is not date"],
        '8,"f,""g""",never,2': ["day is not date"]}
    counts = {r.reason: r.lines for r in io.reject_counts(rejects).collect()}
    assert counts == {"3 fields instead of 4": 1, "5 fields instead of 4": 1, "id is not int": 1, "pct is not double": 1,
                      "day is not date": 2}


def test_header_must_name_the_columns_in_order(spark):
    path = _text(spark, "swapped", "b,a", "1,2")
    with pytest.raises(Exception, match="header does not conform"):
        io.read_csv_checked(spark, path, {"a": "long", "b": "long"}).rows.collect()
    plain = _text(spark, "plain", "1,2", "3")
    good, rejects = io.read_csv_checked(spark, plain, {"a": "long", "b": "long"}, header=False)
    assert rows(good) == [(1, 2)] and [r.line for r in rejects.collect()] == ["3"]
    empty = _text(spark, "empty", "")
    good, rejects = io.read_csv_checked(spark, empty, {"a": "long"}, header=False)
    assert good.collect() == [] and rejects.collect() == []
