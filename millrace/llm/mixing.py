"""Mixing sources to target weights by systematic sampling.

Every document of a source expects rate = target / size copies. Documents stand in a fixed order within
their source, expected copies are prefix-summed, one random offset per source is added, and a document is
emitted once for each integer that its stretch of the sum crosses. The order goes up and down the sizes in
turn, chunk by chunk, so that what a source takes stays within a few documents' sizes of its target.

Prefix sums are taken in chunks of about ``CHUNK`` documents, then over chunk totals, so no source is ever
in one task; the table of sources, one row each, is. Defined results: null or wordless text has size 0 and takes 0 words; null is a source of its
own, the last; an empty table gives an empty result; rows that repeat are sampled each on their own;
only the id, source and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import scratch
from .text import word_count

CHUNK, CAP, CYCLE, SEED = 4096, 3, 3, "mix-1"


def _fraction(key: Column) -> Column:
    """A number in [0, 1) from the first 12 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, cap: int = CAP, cycle: int = CYCLE, seed: str = SEED) -> DataFrame:
    """source, source_docs, source_size, target, rate, chunks, shift; one row per source.

    Weights 1..cycle repeat over the sources by code point, null last. A source whose share of the whole is
    above cap times its size stops there; in order of cap * size / weight, what is left is shared by weight
    among the sources that follow, and the first level at which none is above is the answer.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("source_docs"), F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").isNull(), "source")
    ranked = by_source.withColumn("weight", ((F.row_number().over(named) - 1) % cycle + 1).cast("long")).withColumn("most", F.col("source_size") * cap)
    tightest = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ranked.withColumn("stopped", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(tightest.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.col("weights"))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
        .withColumn("share", F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(Window.partitionBy()))
    )
    open_ = F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), "source") >= F.struct(F.col("share.col1"), F.col("share.col2"), F.col("share.source"))
    target = F.when(F.col("share").isNotNull() & open_, F.col("share.level") * F.col("weight")).otherwise(F.col("most").cast("double"))
    return levels.select(
        "source", "source_docs", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        F.ceil(F.col("source_docs") / CHUNK).cast("long").alias("chunks"),
        _fraction(F.concat(F.lit(seed + "|"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))).alias("shift"),
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken."""
    sizes = scratch(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size")), "sizes")
    targets = scratch(source_targets(sizes, cap, seed=seed), "targets")
    plan = targets.withColumnRenamed("source", "_source")
    rows = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("chunk", F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.col("chunks")))
    in_chunk = Window.partitionBy("source", "chunk").orderBy(F.when(F.col("chunk") % 2 == 0, F.col("size")).otherwise(-F.col("size")), F.col("doc_id").asc_nulls_first())
    ranked = rows.withColumn("place", F.row_number().over(in_chunk))
    counts = rows.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = ranked.join(bases, F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk")))
    end = F.col("base") + F.col("place")
    copies = (F.floor(end * F.col("rate") + F.col("shift")) - F.floor((end - 1) * F.col("rate") + F.col("shift"))).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of docs, each as often as it was emitted, all columns kept.

    Rows that share id, source and size are told apart by nothing that the sampling sees, so their copies
    are pooled and dealt to them in turn.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns may have any name
    doc, source, words = (F.col(names[docs.columns.index(c)]) for c in (id_col, source_col, text_col))
    drawn = mix_sources(docs, id_col, source_col, text_col, cap, seed).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    sized = docs.toDF(*names).select("*", doc.cast("long").alias("own_id"), source.cast("string").alias("own_source"), word_count(words).alias("own_size"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_size") == F.col("size"))
    joined = sized.join(drawn, same)
    alike = Window.partitionBy("own_id", "own_source", "own_size").orderBy(words)
    # almost every row is alone in its group, so no window is needed there
    alone = joined.where("rows = 1").withColumn("times", F.col("copies"))
    several = joined.where("rows > 1").withColumn("nth", F.row_number().over(alike))
    several = several.withColumn("times", F.floor(F.col("copies") * F.col("nth") / F.col("rows")) - F.floor(F.col("copies") * (F.col("nth") - 1) / F.col("rows"))).drop("nth")
    both = alone.unionByName(several).where("times > 0")
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*names).toDF(*docs.columns)
