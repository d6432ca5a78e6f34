"""Readers and writers.

* typed CSV with header (columns matched by position), CSV with inferred
  schema, Parquet;
* typed CSV with a reject row for every line that does not fit the schema;
* registry-driven reads: ``{name: {"path": ..., "columns": [...]}}`` →
  projection + dedup per table (JDBC entries read through Spark's JDBC
  source, projection pruned by Catalyst);
* Parquet writes, optionally partitioned by a column (partition pruning on
  read), dated output paths, compute-if-absent materialisation;
* CSV → Parquet conversion;
* golden result files: ``chaine_contrats`` written ``a|b|c`` parsed back to
  ``array<int>``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type words of the source system's schema files -> Spark types.
# "string_optional" is declared non-nullable there, despite its name.
TYPE_WORDS: dict[str, tuple[T.DataType, bool]] = {
    "integer": (T.IntegerType(), True),
    "long": (T.LongType(), True),
    "string": (T.StringType(), True),
    "double": (T.DoubleType(), True),
    "float": (T.FloatType(), True),
    "date": (T.DateType(), True),
    "bool": (T.BooleanType(), True),
    "array": (T.ArrayType(T.IntegerType()), True),
    "string_optional": (T.StringType(), False),
    "array_string": (T.ArrayType(T.StringType()), True),
    "array_long": (T.ArrayType(T.LongType()), True),
}

# Fixed format of golden restitution files.
EXPECTED_COLUMNS = {
    "ide12": "long",
    "lettrage": "string",
    "numcatal_cedant_origine": "long",
    "role_ad_origine": "string",
    "numcatal_ayant_droit_final": "long",
    "role_ad_final": "string",
    "chaine_contrats": "string_optional",
    "cle": "float",
}


def schema_from_words(columns: Mapping[str, str]) -> T.StructType:
    """StructType from an ordered ``{column: type word}`` mapping."""
    fields = []
    for name, word in columns.items():
        if word not in TYPE_WORDS:
            raise ValueError(f"unknown type word {word!r} for column {name!r}")
        dtype, nullable = TYPE_WORDS[word]
        fields.append(T.StructField(name, dtype, nullable))
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | Mapping[str, str] | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with header; a declared schema maps columns by position."""
    if schema is not None and not isinstance(schema, T.StructType):
        schema = schema_from_words(schema)
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


class CheckedCsv(NamedTuple):
    """Rows that fit their schema, and the others as ``(file, line, reasons)``."""

    rows: DataFrame
    rejects: DataFrame


#: Column that holds a line which does not fit the schema while it is read.
_LINE = "_rejected_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | Mapping[str, str],
                     header: bool = True) -> CheckedCsv:
    """Typed CSV whose rows fit the schema, and a reject row for every line that does not.

    A line with fewer or more fields than columns, with a value that is not of
    its column's type, or with a quote left open is rejected whole instead of
    giving nulls; empty fields are null and fit.  ``reasons`` names the number
    of fields, or each column with its value's type.  With a ``header`` its names must be
    the schema's in the same order (case as the session says), else the read
    fails and names the file.  Empty files give neither rows nor rejects.
    Spark refuses to count either frame without reading a column; the tables of
    :func:`load_csv` can be counted.
    """
    if not isinstance(schema, T.StructType):
        schema = schema_from_words(schema)
    lines = (spark.read.schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())]))
             .option("header", header).option("enforceSchema", not header).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", _LINE).csv(path))
    rows = lines.where(F.col(_LINE).isNull()).drop(_LINE)

    # only rejected lines are parsed a second time, as text
    n = len(schema.fields)
    names = [f"c{i}" for i in range(n)]
    text = F.from_csv(_LINE, ", ".join(f"{name} string" for name in names))
    outside = F.regexp_replace(_LINE, r'"(?:[^"\\]|\\.|"")*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","))) + 1
    reasons = [F.when(fields != n, F.concat(fields.cast("string"), F.lit(f" fields instead of {n}")))]
    for name, field in zip(names, schema.fields):
        unread = F.col(f"_text.{name}").isNotNull() & F.col(f"`{field.name}`").isNull()
        reasons.append(F.when((fields == n) & unread, F.lit(f"{field.name} is not {field.dataType.simpleString()}")))
    named = F.array_compact(F.array(*reasons))
    rejects = (lines.where(F.col(_LINE).isNotNull())
               .withColumns({"_file": F.col("_metadata.file_path"), "_text": text})
               .select(F.col("_file").alias("file"), F.col(_LINE).alias("line"),
                       F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("malformed"))).alias("reasons")))
    return CheckedCsv(rows, rejects)


def load_csv(spark: SparkSession, csv_path: str, table_path: str, schema: T.StructType | Mapping[str, str],
             header: bool = True, mode: str = "errorifexists") -> CheckedCsv:
    """CSV written as a typed Parquet table, its rejects in ``<table_path>_rejects`` beside it; both read back."""
    checked = read_csv_checked(spark, csv_path, schema, header)
    rejects_path = f"{table_path.rstrip('/')}_rejects"
    write_parquet(checked.rejects, rejects_path, mode=mode)
    write_parquet(checked.rows, table_path, mode=mode)
    return CheckedCsv(spark.read.schema(checked.rows.schema).parquet(table_path),
                      spark.read.schema(checked.rejects.schema).parquet(rejects_path))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(file, reason, lines)``: a line with several reasons counts for each."""
    return rejects.select("file", F.explode("reasons").alias("reason")).groupBy("file", "reason").agg(
        F.count("*").alias("lines"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, file_type: str = "parquet",
               dedup: bool = True) -> DataFrame:
    """Read one registry entry: projection (pushed into the scan) then dedup."""
    df = read_csv(spark, path, infer=True) if file_type == "csv" else read_parquet(spark, path)
    if columns:
        df = df.select(*columns)
    return df.dropDuplicates() if dedup else df


def jdbc_options(url: str, table: str, user: str, password: str,
                 driver: str = "org.postgresql.Driver", fetch_size: int = 10000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")`` (credentials passed in, not read here)."""
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
            "fetchsize": str(fetch_size)}


def read_jdbc(spark: SparkSession, options: Mapping[str, str], columns: list[str] | None = None,
              dedup: bool = True) -> DataFrame:
    """JDBC table with projection (Catalyst prunes the column list) and dedup."""
    df = spark.read.format("jdbc").options(**options).load()
    if columns:
        df = df.select(*columns)
    return df.dropDuplicates() if dedup else df


def read_registry(spark: SparkSession, registry: Mapping[str, Mapping], all_columns: bool = False
                  ) -> dict[str, DataFrame]:
    """Read every entry: ``path`` entries from files, ``jdbc`` entries from a database."""
    out = {}
    for name, entry in registry.items():
        cols = None if all_columns else entry.get("columns")
        if "path" in entry:
            out[name] = read_table(spark, entry["path"], cols, entry.get("file_type", "parquet"))
        else:
            out[name] = read_jdbc(spark, entry["jdbc"], cols)
    return out


def read_tables(spark: SparkSession, root: str, names: list[str], schemas: Mapping[str, Mapping] | None = None,
                file_type: str = "parquet", dedup: bool = False, use_case: str | None = None) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for ``root/name`` (CSV with declared schema or Parquet); ``use_case`` is a folder below root."""
    root = "/".join([root.rstrip("/"), *([use_case] if use_case else [])])
    out = {}
    for name in names:
        if file_type == "csv":
            df = read_csv(spark, f"{root}/{name}.csv", (schemas or {}).get(name))
        else:
            df = read_parquet(spark, f"{root}/{name}")
        out[name] = df.dropDuplicates() if dedup else df
    return out


def write_parquet(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                  mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet write; ``partition_by`` enables partition pruning on read.

    ``files`` caps the number of output files via ``coalesce`` – only for
    small outputs, since it funnels the write into that many tasks.
    """
    if files:
        df = df.coalesce(files)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)


def dated_path(root: str, name: str, depth: int, date=None) -> str:
    """``root/name_depth_<d>_<yyyy-mm-dd>`` (today when no date is given)."""
    if date is None:
        date = _dt.date.today()
    if isinstance(date, (_dt.date, _dt.datetime)):
        date = date.isoformat()[:10]
    return f"{root.rstrip('/')}/{name}_depth_{depth}_{date}"


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished write: its ``_SUCCESS`` marker, or a committed snapshot.

    A missing folder, or one with hidden names only (a write that was cut
    off), is absent; a folder with files but no marker is an error, so that
    data of unknown origin is never overwritten.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    if "manifests" in names:
        committed = fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/manifests"))
        names += ["_SUCCESS"] if any(not s.getPath().getName().startswith((".", "_")) for s in committed) else []
    if "_SUCCESS" in names:
        return True
    if any(not n.startswith(("_", ".")) for n in names):
        raise RuntimeError(f"{path} has files but no _SUCCESS marker")
    return False


def read_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame],
                    partition_by: str | None = None) -> DataFrame:
    """Read ``path`` when present, else compute, write and read back.

    The read-back cuts the lineage.  Errors in ``compute`` propagate.
    """
    if exists(spark, path):
        return spark.read.parquet(path)
    write_parquet(compute(), path, partition_by)
    return spark.read.parquet(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, mode: str = "append",
                   files: int | None = None) -> DataFrame:
    """Untyped CSV (header, all strings) appended to a Parquet folder."""
    df = read_csv(spark, csv_path)
    write_parquet(df, parquet_path, mode=mode, files=files)
    return spark.read.parquet(parquet_path)


def parse_pipe_array(c, element_type: str = "int"):
    """``"a | b|c"`` -> ``array<element_type>`` (blanks around the pipe allowed)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(col, r"\|"), lambda x: F.trim(x).cast(element_type))


def read_expected(spark: SparkSession, path: str) -> DataFrame:
    """Golden restitution file: pipe chain -> ``array<int>``, share -> double."""
    df = read_csv(spark, path, EXPECTED_COLUMNS)
    return (df.withColumn("chaine_contrats", parse_pipe_array("chaine_contrats"))
              .withColumn("cle", F.col("cle").cast("double")))


def write_expected(df: DataFrame, path: str) -> None:
    """Restitution result in the golden CSV format (chain written ``a|b|c``)."""
    out = df.withColumn("chaine_contrats",
                        F.array_join(F.transform("chaine_contrats", lambda x: x.cast("string")), "|"))
    out.select(*EXPECTED_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
