"""Repair: missing values by their label's median; labels by a mapping and against a closed domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import infinite_to_missing, quoted
from .medians import checked_broadcast, grouped_medians, same


def impute_medians(df: DataFrame, columns: list[str], keys: tuple[str, ...], fit_on: DataFrame | None = None) -> DataFrame:
    """Missing and infinite values become the median of the rows with the same keys; a group without values stays missing.

    The medians are one row per group and broadcast where those are few, so the table itself is not sorted or
    shuffled for them. fit_on takes them from other rows, such as a training split. A null key is a key.
    """
    clean = infinite_to_missing(df, columns)
    base = clean if fit_on is None else infinite_to_missing(fit_on, columns)
    by, values = [f"_k{i}" for i in range(len(keys))], [f"_m{i}" for i in range(len(columns))]
    narrow = base.select(*[quoted(k).alias(n) for k, n in zip(keys, by, strict=True)], *[quoted(c).cast("double").alias(m) for c, m in zip(columns, values, strict=True)])
    long = grouped_medians(narrow.unpivot(by, values, "feature", "value"), [*by, "feature"])
    medians = long.groupBy(*by).agg(*[F.min(F.when(F.col("feature") == m, F.col("median"))).alias(m) for m in values])
    filled = {c: F.coalesce(quoted(c), F.col(m)) for c, m in zip(columns, values, strict=True)}
    on = same([quoted(k) for k in keys], [F.col(n) for n in by])
    return clean.join(checked_broadcast(medians), on, "left").select(*[filled.get(c, quoted(c)).alias(c) for c in df.columns])


def mapped(label: Column, mapping: dict[str, str]) -> Column:
    """The mapping's value; labels that it does not name stay."""
    if not mapping:
        return label
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label), label)


def normalise_labels(df: DataFrame, label: str, mapping: dict[str, str], raw: str = "Raw_Label") -> DataFrame:
    """label mapped, and the column raw with what it was."""
    return df.withColumn(raw, quoted(label)).withColumn(label, mapped(quoted(label), mapping))


def mapping_report(df: DataFrame, label: str, raw: str = "Raw_Label") -> DataFrame:
    return df.groupBy(quoted(raw).alias("raw_label"), quoted(label).alias("label")).agg(F.count("*").alias("n"))


def label_mismatches(df: DataFrame, raw: str, label: str, mapping: dict[str, str]) -> DataFrame:
    """raw_label, label, expected and n of the rows whose label is not what the mapping makes of the raw one; null is a value."""
    expected = mapped(quoted(raw), mapping)
    wrong = df.select(quoted(raw).alias("raw_label"), quoted(label).alias("label"), expected.alias("expected")).where(~F.col("expected").eqNullSafe(F.col("label")))
    return wrong.groupBy("raw_label", "label", "expected").agg(F.count("*").alias("n"))


def inconsistent_labels(df: DataFrame, label: str) -> DataFrame:
    """canonical (trimmed, lower case) with more than one spelling, and the spellings."""
    kinds = df.where(quoted(label).isNotNull()).select(quoted(label).alias("l")).distinct()
    grouped = kinds.groupBy(F.lower(F.trim("l")).alias("canonical")).agg(F.sort_array(F.collect_set("l")).alias("spellings"))
    return grouped.where(F.size("spellings") > 1).select("canonical", F.size("spellings").cast("long").alias("n_spellings"), F.array_join("spellings", " | ").alias("spellings"))


def label_blemishes(df: DataFrame, label: str) -> DataFrame:
    """n_null, n_blank, n_padded (spaces around a label that is not blank) and padded_labels (distinct ones)."""
    c = quoted(label)
    padded = (c != F.trim(c)) & (F.trim(c) != "")
    return df.agg(F.count_if(c.isNull()).alias("n_null"), F.count_if(F.trim(c) == "").alias("n_blank"), F.count_if(padded).alias("n_padded"), F.count_distinct(F.when(padded, c)).alias("padded_labels"))


def against_domain(df: DataFrame, label: str, domain: list[str]) -> DataFrame:
    """label and status: expected, unexpected or missing, with the rows of each."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("n"))
    known = df.sparkSession.createDataFrame([(x, True) for x in domain], "label string, known boolean")
    both = counts.join(known, "label", "full")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("known"), "expected").otherwise("unexpected")
    return both.select("label", status.alias("status"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
