"""Roles of columns, and predicates over many columns at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

INFINITIES = (float("inf"), float("-inf"))


@dataclass(frozen=True)
class Roles:
    """Which columns are features, which the label, and which names the source of a row."""

    features: tuple[str, ...]
    label: str
    source: str
    raw_label: str | None = None


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def stripped_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def numeric_columns(df: DataFrame, leave_out: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in leave_out]


def feature_columns(df: DataFrame, leave_out: tuple[str, ...], expected: int | None = None) -> list[str]:
    """All columns but those left out, in order; raises if their number is not the expected one."""
    names = [c for c in df.columns if c not in leave_out]
    if expected is not None and len(names) != expected:
        raise ValueError(f"{len(names)} feature columns, {expected} expected")
    return names


def _floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def is_infinite(df: DataFrame, name: str) -> Column:
    """False, not null, for missing values and for columns that hold no floating numbers."""
    return F.coalesce(quoted(name).isin(*INFINITIES), F.lit(False)) if _floating(df, name) else F.lit(False)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column: one notion of missing."""
    return quoted(name).isNull() | F.isnan(quoted(name)) if _floating(df, name) else quoted(name).isNull()


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def infinite_to_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Infinities and NaN of floating columns become null."""
    names = [c for c in (columns or df.columns) if _floating(df, c)]
    return df.withColumns({c: F.when(~(F.isnan(quoted(c)) | quoted(c).isin(*INFINITIES)), quoted(c)) for c in names})


def percentage(part: Column, whole: Column, digits: int = 4) -> Column:
    """100 * part / whole as a double; 0 where the whole is 0 or null."""
    return F.round(F.coalesce(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), F.lit(0.0)), digits)
