"""Exact duplicates, groups of equal feature vectors, and vectors with conflicting labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import Roles, percentage, quoted


def native_id(columns: tuple[str, ...]) -> Column:
    """MD5 over length-prefixed texts of the columns, in order; null and text never meet, NaN is null, and both zeros are one."""
    plain = lambda c: F.when(c == "-0.0", "0.0").when(c != "NaN", c)
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.md5(F.concat(*[part(plain(quoted(c).cast("string"))) for c in columns]).cast("binary"))


def exact_duplicates(df: DataFrame, columns: tuple[str, ...], by: str) -> DataFrame:
    """Per value of by: n_rows, duplicate_groups, duplicate_rows, extra_rows and their share."""
    sizes = df.groupBy(quoted(by).alias("source"), *[quoted(c).alias(f"_{i}") for i, c in enumerate(columns)]).agg(F.count("*").alias("n"))
    n, more = F.col("n"), F.col("n") > 1
    stats = sizes.groupBy("source").agg(
        F.sum(n).alias("n_rows"), F.count_if(more).alias("duplicate_groups"),
        F.sum(F.when(more, n).otherwise(0)).alias("duplicate_rows"), F.sum(n - 1).alias("extra_rows"),
    )
    return stats.withColumn("duplicate_percentage", percentage(F.col("duplicate_rows"), F.col("n_rows")))


def as_metrics(one_row: DataFrame) -> DataFrame:
    """metric and value (double), one row per column of a table of one row."""
    names = one_row.columns
    return one_row.select(*[quoted(c).cast("double").alias(c) for c in names]).unpivot([], names, "metric", "value")


def duplicate_totals(by_source: DataFrame) -> DataFrame:
    sums = by_source.agg(*[F.sum(c).alias(c) for c in ("n_rows", "duplicate_groups", "duplicate_rows", "extra_rows")])
    return as_metrics(sums.withColumn("duplicate_percentage", percentage(F.col("duplicate_rows"), F.col("n_rows"))))


def feature_groups(df: DataFrame, roles: Roles) -> DataFrame:
    """One row per distinct feature vector: id, row_count, labels, label_counts, source_files, is_label_conflict.

    Counts per vector, label and source come first, so that the sets of the second step hold distinct values only.
    A null label or source is in no set. Counts are dealt out by id once, which serves both further steps.
    """
    keyed = df.select(native_id(roles.features).alias("feature_group_id"), quoted(roles.label).alias("label"), quoted(roles.source).alias("source"))
    fine = keyed.groupBy("feature_group_id", "label", "source").agg(F.count("*").alias("n")).repartition("feature_group_id")
    per_label = fine.groupBy("feature_group_id", "label").agg(F.sum("n").alias("n"), F.collect_set("source").alias("sources"))
    groups = per_label.groupBy("feature_group_id").agg(
        F.sum("n").alias("row_count"), F.sort_array(F.collect_set("label")).alias("labels"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n"))))).alias("label_counts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("source_files"),
    )
    sized = groups.withColumn("label_count", F.size("labels")).withColumn("source_file_count", F.size("source_files"))
    return sized.withColumn("is_label_conflict", F.col("label_count") > 1).withColumn("is_cross_source", F.col("source_file_count") > 1)


def packed(values: Column) -> Column:
    return F.array_join(values, " | ")


def packed_groups(groups: DataFrame) -> DataFrame:
    """The groups with their lists as text, for reports."""
    return groups.select("feature_group_id", "row_count", "label_count", packed(F.col("labels")).alias("labels"), "source_file_count", packed(F.col("source_files")).alias("source_files"), "is_label_conflict")


def parsed_list(text: Column) -> Column:
    """The sorted parts of a packed list; null and blank give an empty one."""
    return F.array_sort(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != ""))


def parsed_counts(text: Column) -> Column:
    """map<label, long> of packed counts, ``A: 10 | B: 5``; an item is cut at its last colon, items without one are left out."""
    items = F.filter(parsed_list(text), lambda x: F.regexp_like(x, F.lit(r":\s*[0-9]+$")))
    return F.map_from_entries(F.transform(items, lambda x: F.struct(F.trim(F.regexp_replace(x, r":[^:]*$", "")).alias("key"), F.trim(F.substring_index(x, ":", -1)).cast("long").alias("value"))))


def feature_duplicates(groups: DataFrame) -> DataFrame:
    """metric and value: groups of more than one row across all sources, their rows, and the rows beyond the first."""
    more = F.col("row_count") > 1
    sums = groups.agg(F.count_if(more).alias("duplicate_groups"), F.coalesce(F.sum(F.when(more, F.col("row_count"))), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("extra_rows"), F.count_if(more & F.col("is_cross_source")).alias("cross_source_groups"))
    return as_metrics(sums)


def rare_labels(involvement: DataFrame, divisor: int) -> DataFrame:
    """Labels with at most one part in divisor of all records."""
    total = involvement.agg(F.sum("record_count").alias("total"))  # one row
    return involvement.join(F.broadcast(total)).where(F.col("record_count") * divisor <= F.col("total")).drop("total")


def conflicts(groups: DataFrame) -> DataFrame:
    return groups.where("is_label_conflict")


def conflict_report(groups: DataFrame) -> DataFrame:
    counts = F.transform(F.map_entries("label_counts"), lambda e: F.concat_ws(": ", e["key"], e["value"].cast("string")))
    return conflicts(groups).select("feature_group_id", F.col("row_count").alias("occurrences"), "label_count", packed(F.col("labels")).alias("labels"), packed(counts).alias("label_counts"), "source_file_count", packed(F.col("source_files")).alias("source_files"))


def conflict_summary(groups: DataFrame) -> DataFrame:
    """metric and value over the conflicts; shares of an empty set are 0."""
    cross = F.col("is_cross_source")
    one = conflicts(groups).agg(
        F.count("*").alias("conflict_groups"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("conflict_rows"), F.count_if(cross).alias("cross_source_groups"),
        F.count_if(~cross).alias("same_source_groups"), F.coalesce(F.max("label_count"), F.lit(0)).alias("most_labels"), F.coalesce(F.max("row_count"), F.lit(0)).alias("largest_group"),
    )
    return as_metrics(one.withColumn("cross_source_percentage", percentage(F.col("cross_source_groups"), F.col("conflict_groups"))))


def conflict_labels(groups: DataFrame) -> DataFrame:
    rows = conflicts(groups).select("is_cross_source", F.explode("label_counts").alias("label", "n"))
    return rows.groupBy("label").agg(F.count("*").alias("conflict_groups"), F.sum("n").alias("rows_in_conflicts"), F.count_if("is_cross_source").alias("cross_source_groups"), F.count_if(~F.col("is_cross_source")).alias("same_source_groups"))


def conflict_pairs(groups: DataFrame) -> DataFrame:
    """Unordered pairs of labels that meet in a conflict; a pair counts the rows of its two labels."""
    entries = F.map_entries("label_counts")
    rows = conflicts(groups).select("is_cross_source", F.explode(entries).alias("a"), entries.alias("all")).select("is_cross_source", "a", F.explode("all").alias("b")).where("a.key < b.key")
    return rows.groupBy(F.col("a.key").alias("label_a"), F.col("b.key").alias("label_b")).agg(F.count("*").alias("conflict_groups"), F.sum(F.col("a.value") + F.col("b.value")).alias("rows_in_conflicts"), F.count_if("is_cross_source").alias("cross_source_groups"), F.count_if(~F.col("is_cross_source")).alias("same_source_groups"))


def conflict_sources(groups: DataFrame) -> DataFrame:
    return conflicts(groups).select(F.explode("source_files").alias("source")).groupBy("source").agg(F.count("*").alias("conflict_groups"))


def single_label_counts(groups: DataFrame) -> DataFrame:
    return groups.where("label_count = 1").groupBy(F.col("labels")[0].alias("label")).agg(F.sum("row_count").alias("n_records"))


def label_involvement(groups: DataFrame) -> DataFrame:
    """Per label: groups, records (each label of a group counts the whole group) and groups of several labels."""
    rows = groups.select(F.explode("labels").alias("label"), "row_count", "is_label_conflict")
    return rows.groupBy("label").agg(F.count("*").alias("group_count"), F.sum("row_count").alias("record_count"), F.count_if("is_label_conflict").alias("multi_label_groups"))
