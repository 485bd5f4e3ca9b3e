"""Declared expectations, all row-level ones of a table in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """An aggregate over the table and the number that it should be."""

    name: str
    actual: Column
    expected: int


class CheckFailed(ValueError):
    pass


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """check, expected, actual, status (PASS or FAIL)."""
    one = df.agg(*[c.actual.cast("long").alias(c.name) for c in checks])
    aims = F.create_map(*[F.lit(x) for c in checks for x in (c.name, c.expected)])
    long = one.unpivot([], one.columns, "check", "actual").withColumn("expected", aims[F.col("check")].cast("long"))
    return long.select("check", "expected", "actual", F.when(F.col("actual").eqNullSafe(F.col("expected")), "PASS").otherwise("FAIL").alias("status"))


def raise_on_fail(report: DataFrame) -> None:
    failed = [r["check"] for r in report.where("status = 'FAIL'").toLocalIterator()]
    if failed:
        raise CheckFailed(", ".join(failed))


def schema_checks(df: DataFrame, required: list[str], n_columns: int | None = None) -> DataFrame:
    """check, detail, status over the column names alone; no row is read."""
    have = df.columns
    lacking, extra = sorted(set(required) - set(have)), sorted(set(have) - set(required))
    twice = sorted({c for c in have if have.count(c) > 1})
    rows = [("required_columns", ", ".join(lacking), not lacking), ("extra_columns", ", ".join(extra), not extra), ("repeated_columns", ", ".join(twice), not twice), ("column_order", "", [c for c in have if c in required] == required)]
    if n_columns is not None:
        rows.append(("column_count", str(len(have)), len(have) == n_columns))
    return df.sparkSession.createDataFrame([(a, b, "PASS" if ok else "FAIL") for a, b, ok in rows], "check string, detail string, status string")
