"""Exact medians per group, however large a group is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import quoted

#: The sketch's accuracy, and how far its two quantiles stand from the middle.
ACCURACY, SLACK = 100_000, 2e-5
#: Up to so many groups a table of one row per group is broadcast; beyond that it is joined by a shuffle.
MAX_GROUPS = 10_000


def same(left: list[Column], right: list[Column]) -> Column:
    """Whether two lists of keys are equal; null equals null."""
    return reduce(lambda x, y: x & y, (a.eqNullSafe(b) for a, b in zip(left, right, strict=True)), F.lit(True))


def checked_broadcast(per_group: DataFrame) -> DataFrame:
    """per_group marked for broadcast if it has at most MAX_GROUPS rows, which are counted first; else as it is."""
    rows = per_group.limit(MAX_GROUPS + 1).collect()
    return F.broadcast(per_group.sparkSession.createDataFrame(rows, per_group.schema)) if len(rows) <= MAX_GROUPS else per_group


def grouped_medians(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys and median, one row per group that has a value. A null key is a key.

    Two sketched quantiles around the middle cut each group in three parts. Their exact counts tell which part holds
    the middle ranks, and only the distinct values of that part are sorted: some 4 of 100,000 rows of a group. A sketch that
    misses the middle makes the part larger and never the result wrong. Rows are not shuffled but for their counts.
    """
    names = [f"k{i}" for i in range(len(keys))]
    plain = rows.select(*[quoted(k).alias(n) for k, n in zip(keys, names, strict=True)], quoted(value).cast("double").alias("v")).where("v is not null")
    other = [F.col(f"_{n}") for n in names]
    renamed = lambda df: df.withColumnsRenamed({n: f"_{n}" for n in names})

    edges = plain.groupBy(*names).agg(F.percentile_approx("v", [0.5 - SLACK, 0.5 + SLACK], ACCURACY).alias("e")).select(*names, F.col("e")[0].alias("lo"), F.col("e")[1].alias("hi"))
    mine = [F.col(n) for n in names]
    part = F.when(F.col("v") < F.col("lo"), 0).when(F.col("v") <= F.col("hi"), 1).otherwise(2)
    cut = plain.join(checked_broadcast(renamed(edges)), same(mine, other)).select(*names, "v", part.alias("part"))

    sizes = cut.groupBy(*names).agg(F.count("*").alias("n"), F.count_if(F.col("part") == 0).alias("n0"), F.count_if(F.col("part") == 1).alias("n1"))
    ranks = sizes.withColumns({"r1": F.floor((F.col("n") + 1) / 2), "r2": F.floor(F.col("n") / 2) + 1})
    part_of = lambda r: F.when(F.col(r) <= F.col("n0"), 0).when(F.col(r) <= F.col("n0") + F.col("n1"), 1).otherwise(2)
    ranks = ranks.withColumns({"p1": part_of("r1"), "p2": part_of("r2")})
    before = F.when(F.col("p1") == 0, 0).when(F.col("p1") == 1, F.col("n0")).otherwise(F.col("n0") + F.col("n1"))
    ranks = ranks.select(*names, "r1", "r2", "p1", "p2", before.cast("long").alias("before"))

    middle = cut.join(checked_broadcast(renamed(ranks)), same(mine, other)).where(F.col("part").between(F.col("p1"), F.col("p2")))
    values = middle.groupBy(*names, "r1", "r2", "before", "v").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*names).orderBy("v"))
    reached = lambda r: F.min(F.when(F.col("upto") >= F.col(r), F.col("v")))
    found = values.withColumn("upto", upto).groupBy(*names).agg(reached("r1").alias("a"), reached("r2").alias("b"))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], (0.5 * F.col("a") + 0.5 * F.col("b")).alias("median"))
