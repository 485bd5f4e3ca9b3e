"""Rows to their splits, one-to-one joins that are checked, and the audit of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import Roles, quoted
from .duplicates import native_id


def route(df: DataFrame, roles: Roles, assignment: DataFrame) -> DataFrame:
    """df with Source_File and split; rows without an assignment raise when they are read."""
    keyed = df.withColumn("_id", native_id(roles.features))
    split = assignment.select(F.col("feature_group_id").alias("_id"), "split")
    joined = keyed.join(split, "_id", "left")
    found = F.coalesce("split", F.raise_error(F.lit("a row has no assignment")).cast("string"))
    return joined.select(*[quoted(c) for c in df.columns], quoted(roles.source).alias("Source_File"), found.alias("split"))


def write_splits(routed: DataFrame, path: str, overwrite: bool = False) -> None:
    """One pass; a directory per split. Existing output raises unless overwrite."""
    routed.write.partitionBy("split").option("compression", "snappy").mode("overwrite" if overwrite else "errorifexists").parquet(path)


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """check and n: repeated keys on either side and keys without a partner; all 0 for a one-to-one join."""
    a = left.groupBy(quoted(key).alias(key)).agg(F.count("*").alias("l"))
    b = right.groupBy(quoted(key).alias(key)).agg(F.count("*").alias("r"))
    sums = a.join(b, key, "full").agg(
        F.count_if(F.col("l") > 1).alias("repeated_left"), F.count_if(F.col("r") > 1).alias("repeated_right"), F.count_if(F.col("r").isNull()).alias("missing_right"),
        F.count_if(F.col("l").isNull()).alias("missing_left"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("matched"),
    )
    return sums.unpivot([], sums.columns, "check", "n")


def leakage_audit(routed: DataFrame, roles: Roles, assignment: DataFrame) -> DataFrame:
    """metric and n: rows, distinct vectors, vectors in several splits, misplaced rows, rows not assigned. Ids are computed anew."""
    per_group = routed.groupBy(native_id(roles.features).alias("feature_group_id"), "split").agg(F.count("*").alias("n"))
    joined = per_group.join(assignment.select("feature_group_id", F.col("split").alias("expected")), "feature_group_id", "left")
    per_id = joined.groupBy("feature_group_id").agg(
        F.count("*").alias("splits"), F.sum("n").alias("n"), F.sum(F.when(F.col("split") != F.col("expected"), F.col("n")).otherwise(0)).alias("misplaced"), F.sum(F.when(F.col("expected").isNull(), F.col("n")).otherwise(0)).alias("unassigned")
    )
    sums = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_groups"), F.count_if(F.col("splits") > 1).alias("groups_in_several_splits"),
        F.coalesce(F.sum("misplaced"), F.lit(0)).alias("misplaced_rows"), F.coalesce(F.sum("unassigned"), F.lit(0)).alias("unassigned_rows"),
    )
    return sums.unpivot([], sums.columns, "metric", "n")


def written_audit(spark: SparkSession, path: str, roles: Roles, assignment: DataFrame) -> DataFrame:
    """check and n over splits as they were written: rows, lacking_columns, extra_columns (the group's id among them), labels_not_in_every_split, and what ``leakage_audit`` finds, ids computed anew from the files."""
    rows = spark.read.parquet(path)
    expected = {*roles.features, roles.label, "Source_File", "split"}
    have = set(rows.columns) - {roles.source}
    per_label = rows.where(quoted(roles.label).isNotNull()).groupBy(quoted(roles.label).alias("label")).agg(F.count_distinct("split").alias("splits"))
    n_splits = rows.select("split").distinct().agg(F.count("*").alias("n"))  # one row
    lacking = per_label.join(F.broadcast(n_splits)).agg(F.count_if(F.col("splits") < F.col("n")).alias("n"))
    names = spark.createDataFrame([("lacking_columns", len(expected - have - {roles.source})), ("extra_columns", len(have - expected))], "metric string, n long")
    return names.unionByName(lacking.select(F.lit("labels_not_in_every_split").alias("metric"), "n")).unionByName(leakage_audit(rows, roles, assignment)).withColumnRenamed("metric", "check")
