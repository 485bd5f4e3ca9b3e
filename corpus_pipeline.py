"""The corpus pipeline: five stages over documents, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, line_dedup, mixing, packing, quality
from millrace.llm.queries import tokenizer_path
from millrace.llm.scratch import mark, release, scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the decision list learned from labels keep."""
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_documents(docs, rules)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, equal or one edit away, go; so do documents without a line left."""
    return line_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at a Jaccard similarity of 0.8 of five-word shingles."""
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most a sequence's length, with their place."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mix", mixed),
    ("best_fit_packing", packed),
]

#: Fitted rules and tokenizer ids have no SQL form; tests/llm/test_pipeline.py holds run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
        release(spark, start, spared=1)  # all that the written stage was made from
    return STAGES[-1][1](spark, docs, sf_dir)
