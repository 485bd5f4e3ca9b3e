"""Whole feature groups to train, validation and test, so that no vector is in two splits.

``split_windowed`` is the mode for large tables: groups stand in the order of their ids within their first
label, and a group's split follows from the share of rows before it. Sums are taken within the first digits of
the id, then over those, so no label is ever in one task.

``split_greedy`` gives each group to the split that lacks most, one after the other. Each decision depends on all
before it, so it is one sorted stream through one task, which holds counters only; the sort spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import percentage, quoted

# The splits' shares, and the weights of the greedy score.
RATIOS = {"train": 0.70, "validation": 0.15, "test": 0.15}
LABEL_WEIGHT, GLOBAL_WEIGHT, CONFLICT_WEIGHT, CROSS_SOURCE_WEIGHT = 0.75, 0.25, 3.0, 1.5
RARE_RECORDS, TIE_MODULUS = 1000, 997
#: Hex digits of an id that make a bucket of the prefix sums: 65,536 buckets a label, one row each in the second sums.
DIGITS = 4


def splits_table(df: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame([(k, s, r) for k, (s, r) in enumerate(ratios.items())], "split_no int, split string, target_ratio double"))  # one row per split


def split_targets(involvement: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """Per label and split the records aimed at: the label's records, whole groups counted, times the ratio."""
    return involvement.crossJoin(splits_table(involvement, ratios)).select("label", "split", "target_ratio", (F.col("record_count") * F.col("target_ratio")).alias("target_records"))


def by_share(share: Column, ratios: dict[str, float] = RATIOS) -> Column:
    """The split in whose stretch of [0, 1) a share lies."""
    names, edge, out = list(ratios), 0.0, None
    for name in names[:-1]:
        edge = round(edge + ratios[name], 12)
        out = F.when(share < edge, name) if out is None else out.when(share < edge, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def split_windowed(groups: DataFrame, ratios: dict[str, float] = RATIOS, digits: int = DIGITS) -> DataFrame:
    """groups with split, the same for any digits. Groups without a label are a label of their own."""
    rows = groups.withColumn("_label", F.coalesce(F.get("labels", F.lit(0)), F.lit(""))).withColumn("_bucket", F.substring("feature_group_id", 1, digits))
    sums = rows.groupBy("_label", "_bucket").agg(F.sum("row_count").alias("n"))
    per_label = Window.partitionBy("_label")
    before = per_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_label", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"), F.sum("n").over(per_label).alias("_total"))
    within = Window.partitionBy("_label", "_bucket").orderBy("feature_group_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("row_count").over(within), F.lit(0))).join(bases, ["_label", "_bucket"])
    share = (F.col("_base") + F.col("_within")).cast("double") / F.col("_total")
    return placed.withColumn("split", by_share(share, ratios)).select(*groups.columns, "split")


def _tie_seed(group_id: str) -> int:
    return int.from_bytes(hashlib.blake2b(group_id.encode(), digest_size=8).digest(), "little")


class Allocator:
    """The counters of the greedy allocation, one number per split in each."""

    def __init__(self, ratios: dict[str, float], label_records: dict[str, int], records: int, conflict_records: int, cross_groups: int):
        share = np.array(list(ratios.values()))
        self.names = list(ratios)
        self.aims = {label: n * share for label, n in label_records.items()}
        self.had = {label: np.zeros(len(share)) for label in label_records}
        self.all_aim, self.all_had = records * share, np.zeros(len(share))
        # the second bonus weighs records against a target in groups, as the published figures do
        self.bonus = {0: (CONFLICT_WEIGHT, conflict_records * share, np.zeros(len(share))), 1: (CROSS_SOURCE_WEIGHT, cross_groups * share, np.zeros(len(share)))}

    @staticmethod
    def _lack(aim: np.ndarray, had: np.ndarray) -> np.ndarray:
        return (aim - had) / np.maximum(aim, 1.0)

    def take(self, group_id: str, size: int, labels: list[str], stage: int) -> str:
        lacks = sum((self._lack(self.aims[x], self.had[x]) for x in labels), np.zeros(len(self.names))) / max(len(labels), 1)
        score = LABEL_WEIGHT * lacks + GLOBAL_WEIGHT * self._lack(self.all_aim, self.all_had)
        if stage in self.bonus:
            weight, aim, had = self.bonus[stage]
            score = score + weight * self._lack(aim, had)
        best = np.flatnonzero(score == score.max())
        k = int(best[0]) if len(best) == 1 else min(best.tolist(), key=lambda j: (_tie_seed(group_id) + j) % TIE_MODULUS)
        for counter in (self.all_had, *(self.had[x] for x in labels), *([self.bonus[stage][2]] if stage in self.bonus else [])):
            counter[k] += size
        return self.names[k]


def split_greedy(groups: DataFrame, involvement: DataFrame, ratios: dict[str, float] = RATIOS, rare_records: int = RARE_RECORDS) -> DataFrame:
    """feature_group_id, split. Groups of several labels first, then those of several sources, rare labels, the rest.

    Within the first two stages larger groups first, then by id; within the others labels by their records and
    name come before that. involvement holds one row per label, which is what the driver reads.
    """
    label_records = {r["label"]: r["record_count"] for r in involvement.select("label", "record_count").toLocalIterator()}
    totals = groups.agg(F.coalesce(F.sum("row_count"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("is_label_conflict"), F.col("row_count"))), F.lit(0)), F.count_if("is_cross_source")).first()
    order = {label: k for k, label in enumerate(sorted(label_records, key=lambda x: (label_records[x], x)))}
    rare = [x for x in label_records if label_records[x] <= rare_records]
    one = F.get("labels", F.lit(0))
    stage = F.when(F.col("is_label_conflict"), 0).when(F.col("is_cross_source"), 1).when(one.isin(rare), 2).otherwise(3)
    place = F.when(stage < 2, 0).otherwise(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), one), F.lit(-1)) if order else F.lit(-1))
    queue = groups.select("feature_group_id", "row_count", "labels", stage.alias("stage"), place.alias("place")).repartition(1).sortWithinPartitions("stage", "place", F.desc("row_count"), "feature_group_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allocator = Allocator(ratios, label_records, *totals)
        for batch in batches:
            got = [allocator.take(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("feature_group_id", "row_count", "labels", "stage")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("feature_group_id"), pa.array(got, pa.string())], ["feature_group_id", "split"])

    return queue.mapInArrow(run, "feature_group_id string, split string")


def _dense(counts: DataFrame, ratios: dict[str, float]) -> DataFrame:
    return splits_table(counts, ratios).drop("split_no").join(counts, "split", "left")


def record_counts(assigned: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """Per split, empty ones too: groups, records, actual_ratio, target_ratio, difference."""
    counts = assigned.groupBy("split").agg(F.count("*").alias("groups"), F.sum("row_count").alias("records"))
    dense = _dense(counts, ratios).na.fill(0, ["groups", "records"])
    ratio = F.coalesce(F.try_divide(F.col("records").cast("double"), F.sum("records").over(Window.partitionBy()).cast("double")), F.lit(0.0))
    return dense.select("split", "groups", "records", F.round(ratio, 6).alias("actual_ratio"), "target_ratio", F.round(ratio - F.col("target_ratio"), 6).alias("difference"))


def flagged_counts(assigned: DataFrame, flag: str, prefix: str, ratios: dict[str, float] = RATIOS) -> DataFrame:
    counts = assigned.where(quoted(flag)).groupBy("split").agg(F.count("*").alias(f"{prefix}_groups"), F.sum("row_count").alias(f"{prefix}_records"))
    return _dense(counts, ratios).drop("target_ratio").na.fill(0, [f"{prefix}_groups", f"{prefix}_records"])


def label_pivot(assigned: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """Per label: total_groups, total_records, and groups, records and percentage of each split."""
    rows = assigned.select(F.explode("labels").alias("label"), "split", "row_count")
    sums = [x for s in ratios for x in (F.count_if(F.col("split") == s).alias(f"{s}_groups"), F.coalesce(F.sum(F.when(F.col("split") == s, F.col("row_count"))), F.lit(0)).alias(f"{s}_records"))]
    table = rows.groupBy("label").agg(F.count("*").alias("total_groups"), F.sum("row_count").alias("total_records"), *sums)
    return table.withColumns({f"{s}_percentage": percentage(F.col(f"{s}_records"), F.col("total_records")) for s in ratios})


def row_pivot(rows: DataFrame, key: str, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """Per value of key the rows of each split, and total."""
    return rows.groupBy(quoted(key).alias(key)).agg(*[F.count_if(F.col("split") == s).alias(s) for s in ratios], F.count("*").alias("total"))


def split_design(groups: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """Per split: target_ratio, target_records (of all records, rounded), largest_group, and fits: whether that group is within the target."""
    total = groups.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"), F.coalesce(F.max("row_count"), F.lit(0)).alias("largest_group"))
    aims = total.crossJoin(splits_table(groups, ratios)).withColumn("target_records", F.round(F.col("n") * F.col("target_ratio")).cast("long"))  # one row times the splits
    return aims.select("split", "target_ratio", "target_records", "largest_group", (F.col("largest_group") <= F.col("target_records")).alias("fits"))


def assignment_report(groups: DataFrame, assignment: DataFrame, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """check and n, all 0 for a whole assignment: repeated_ids, null_splits, outside_domain, missing_ids, unknown_ids, and lost_records (rows of groups less rows assigned, each row of an assignment counted)."""
    split = F.col("split")
    per_id = assignment.groupBy("feature_group_id").agg(F.count("*").alias("times"), F.count_if(split.isNull()).alias("nulls"), F.count_if(~split.isin(*ratios)).alias("outside"))
    both = groups.select("feature_group_id", "row_count").join(per_id, "feature_group_id", "full")
    sums = both.agg(
        F.count_if(F.col("times") > 1).alias("repeated_ids"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_splits"), F.coalesce(F.sum("outside"), F.lit(0)).alias("outside_domain"),
        F.count_if(F.col("times").isNull()).alias("missing_ids"), F.count_if(F.col("row_count").isNull()).alias("unknown_ids"),
        F.coalesce(F.sum(F.coalesce("row_count", F.lit(0)) * (1 - F.coalesce("times", F.lit(0)))), F.lit(0)).alias("lost_records"),
    )
    return sums.unpivot([], sums.columns, "check", "n")
