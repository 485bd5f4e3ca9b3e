"""BLAKE2b fingerprints of feature vectors, and of whole assignments. Spark has no BLAKE2b, so rows go through Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import quoted


def canonical(value: object) -> str:
    """Missing values alike, floating numbers in 17 significant digits, all else as text."""
    if value is None or value != value:
        return "<NA>"
    return format(value, ".17g") if isinstance(value, float) else str(value)


def fingerprint(values: tuple) -> str:
    """32 hex digits over 4-byte big-endian lengths and UTF-8 texts."""
    h = hashlib.blake2b(digest_size=16)
    for value in values:
        data = canonical(value).encode()
        h.update(len(data).to_bytes(4, "big") + data)
    return h.hexdigest()


def with_fingerprint(df: DataFrame, features: tuple[str, ...], name: str = "feature_group_id") -> DataFrame:
    """df with a column name, the fingerprint of its features."""
    schema = df.select(*[quoted(c) for c in df.columns], F.lit("").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in features]
            yield batch.append_column(name, pa.array([fingerprint(v) for v in zip(*columns, strict=True)], pa.string()))

    return df.mapInArrow(run, schema)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """sha256 over the sorted rows' own hashes, and n_rows, without a row on the driver.

    Each of 65,536 buckets, by the first digits of a row's hash, is hashed in order; then the buckets' hashes are.
    """
    text = F.to_json(F.struct(*[quoted(c) for c in df.columns]), {"ignoreNullFields": "false"})
    rows = df.select(F.sha2(text, 256).alias("h"))
    fold = rows.groupBy("h").agg(F.count("*").alias("n")).groupBy(F.substring("h", 1, 4).alias("bucket")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat("h", F.lit(" "), "n"))), ","), 256).alias("b"), F.sum("n").alias("n"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "b"))), lambda x: x["b"])
    return fold.agg(F.sha2(F.array_join(ordered, ","), 256).alias("sha256"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
