"""Delimited and Parquet inputs with the file of each row, and the sinks for data and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.columns import quoted, stripped_headers

CORRUPT = "_corrupt_record"


def discover(spark: SparkSession, directory: str, pattern: str = "*.csv") -> DataFrame:
    """file_name and length of the files of a directory, not of those below it; a missing directory raises."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(directory)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, source: str | None = "Source_File", strict: bool = True) -> DataFrame:
    """CSV under a fixed schema, by position, so that header spaces and repeated names do no harm.

    strict raises on a malformed row; otherwise it has nulls and its text in a column _corrupt_record.
    """
    reader = spark.read.option("header", True).option("enforceSchema", True)
    if strict:
        df = reader.option("mode", "FAILFAST").schema(schema).csv(path)
    else:
        full = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(StructType(full.fields).add(CORRUPT, "string")).csv(path)
    return df if source is None else df.select("*", F.col("_metadata.file_name").alias(source))


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV, trimmed; its rows are not read."""
    return stripped_headers(spark.read.option("header", True).csv(path).limit(0)).columns


def label_column(columns: list[str], label: str = "Label") -> str | None:
    return next((c for c in columns if c.strip() == label), None)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[quoted(c) for c in columns])


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.option("header", True).option("encoding", "UTF-8").mode("overwrite" if overwrite else "errorifexists").csv(path)


def write_report(df: DataFrame, path: str, kind: str = "csv", overwrite: bool = True) -> None:
    """A small table as one file, CSV or JSON lines."""
    writer = df.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.option("compression", "snappy").mode("overwrite" if overwrite else "errorifexists").parquet(path)


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """file_name, n_rows and n_columns per Parquet file; no data column is read, counts come from the footers."""
    df = spark.read.parquet(path)
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def expect_files(files: DataFrame, n: int) -> DataFrame:
    """files, if there are n of them; otherwise ValueError."""
    found = files.count()
    if found != n:
        raise ValueError(f"{found} files where {n} are expected")
    return files


def file_status(spark: SparkSession, directory: str, schema: StructType | str, pattern: str = "*.csv") -> DataFrame:
    """file_name, length, n_rows, n_corrupt and status (ok, corrupt_rows, empty) of each CSV of a directory; a malformed row stops neither its file nor the others. Files of no byte are not listed by Spark."""
    rows = read_csv(spark, f"{directory}/{pattern}", schema, "file_name", strict=False)
    fields = [c for c in rows.columns if c not in (CORRUPT, "file_name")]
    parsed = F.hash(*[quoted(c) for c in fields]) >= -(1 << 31)  # always so, but rows are parsed only for fields that are asked for
    counts = rows.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col(CORRUPT).isNotNull() & parsed).alias("n_corrupt"))
    joined = discover(spark, directory, pattern).join(counts, "file_name", "left").na.fill(0, ["n_rows", "n_corrupt"])
    status = F.when(F.col("n_rows") == 0, "empty").when(F.col("n_corrupt") > 0, "corrupt_rows").otherwise("ok")
    return joined.withColumn("status", status)


def output_sizes(spark: SparkSession, directory: str, pattern: str = "*.parquet") -> DataFrame:
    """folder, n_files and n_bytes of what was written below a directory; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(directory)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder"), "length").groupBy("folder").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def json_document(tables: dict[str, DataFrame], indent: int = 2) -> str:
    """One JSON document of small report tables: a table of metric and value as an object, any other as a list of objects."""
    out: dict[str, object] = {}
    for name, table in tables.items():
        rows = [r.asDict(recursive=True) for r in table.collect()]
        out[name] = {r["metric"]: r["value"] for r in rows} if set(table.columns) == {"metric", "value"} else rows
    return json.dumps(out, indent=indent, default=str, sort_keys=True)


def text_report(title: str, tables: dict[str, DataFrame]) -> str:
    """A plain text report of small tables, columns padded, one section each."""
    lines = [title, "=" * len(title)]
    for name, table in tables.items():
        cells = [table.columns, *[["" if v is None else str(v) for v in r] for r in table.collect()]]
        widths = [max(len(row[k]) for row in cells) for k in range(len(table.columns))]
        lines += ["", name, "-" * len(name), *["  ".join(v.ljust(w) for v, w in zip(row, widths, strict=True)).rstrip() for row in cells]]
    return "\n".join(lines) + "\n"
