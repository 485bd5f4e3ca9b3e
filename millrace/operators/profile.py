"""Profiles: label frequencies, missing and infinite cells, descriptive statistics, file lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .columns import any_of, infinite_to_missing, is_infinite, is_missing, numeric_columns, percentage, quoted
from .medians import checked_broadcast, grouped_medians, same


def label_counts(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """label, n and its share of the rows with the same by columns. One partial aggregation; the window sees only its result."""
    counts = df.groupBy(*[quoted(c) for c in by], quoted(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.withColumn("percentage", percentage(F.col("n"), F.sum("n").over(Window.partitionBy(*by))))


def missing_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name and n_missing of the columns with a missing cell; one pass over the table."""
    one = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "n_missing").where("n_missing > 0")


def missing_by_label(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    return df.where(any_of([is_missing(df, c) for c in columns])).groupBy(quoted(label).alias("label")).agg(F.count("*").alias("n_rows"))


def missing_summary(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    flags = [is_missing(df, c) for c in columns]
    cells = sum((F.count_if(x) for x in flags), F.lit(0))
    return df.groupBy(quoted(by).alias("source")).agg(F.count("*").alias("n_rows"), cells.cast("long").alias("missing_cells"), F.count_if(any_of(flags)).alias("affected_rows"))


def infinite_summary(df: DataFrame) -> DataFrame:
    """n_rows, infinite_cells and infinite_rows over all numeric columns."""
    flags = [is_infinite(df, c) for c in numeric_columns(df)]
    return df.agg(F.count("*").alias("n_rows"), sum((F.count_if(x) for x in flags), F.lit(0)).cast("long").alias("infinite_cells"), F.count_if(any_of(flags)).alias("infinite_rows"))


def dtype_profile(df: DataFrame) -> DataFrame:
    rows = [(k, f.name, f.dataType.simpleString(), isinstance(f.dataType, NumericType)) for k, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string, is_numeric boolean")


def describe_by_label(df: DataFrame, columns: list[str], label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Per label and feature: n, n_missing, mean, median, std, min, max; features without a value give no row."""
    clean = infinite_to_missing(df, columns)
    long = clean.select(*[quoted(c) for c in by], quoted(label).alias("label"), *[quoted(c).cast("double").alias(c) for c in columns]).unpivot([*by, "label"], columns, "feature", "value")
    value = F.col("value")
    stats = long.groupBy(*by, "label", "feature").agg(
        F.count(value).alias("n"), F.count_if(value.isNull()).alias("n_missing"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )
    names = [*by, "label", "feature"]
    medians = grouped_medians(long, names).toDF(*[f"_k{i}" for i in range(len(names))], "median")
    joined = stats.where("n > 0").join(checked_broadcast(medians), same([quoted(k) for k in names], [F.col(f"_k{i}") for i in range(len(names))]))
    return joined.select(*[quoted(k) for k in names], "n", "n_missing", "mean", "median", "std", "min", "max")


def reconcile(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key and status: found, missing (expected only) or unexpected (found only)."""
    a, b = (x.select(quoted(key).alias(key)).distinct().withColumn(flag, F.lit(True)) for x, flag in ((found, "_f"), (expected, "_e")))
    status = F.when(F.col("_f") & F.col("_e"), "found").when(F.col("_e"), "missing").otherwise("unexpected")
    return a.join(b, key, "full").select(key, status.alias("status"))


def group_size_stats(groups: DataFrame, size: str = "row_count", thresholds: tuple[int, ...] = (10, 100)) -> DataFrame:
    n = quoted(size)
    over = [F.count_if(n >= t).alias(f"at_least_{t}") for t in thresholds]
    return groups.agg(F.min(n).alias("smallest"), F.max(n).alias("largest"), F.avg(n).alias("mean"), F.median(n).alias("median"), F.count_if(n == 1).alias("singletons"), F.count_if(n > 1).alias("repeated"), *over)


def ranked(counts: DataFrame, largest_first: list[str], then: list[str], top: int | None = None) -> DataFrame:
    """counts in the order of a report: numbers falling, then names rising so that ties have one order; rank from 1. top keeps the first rows without a sort of all."""
    order = [F.col(c).desc_nulls_last() for c in largest_first] + [F.col(c).asc_nulls_first() for c in then]
    rows = counts.orderBy(*order) if top is None else counts.orderBy(*order).limit(top)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
