"""N-gram Jaccard join by prefix lists with set-relation skipping.

Documents with one shingle set are one class, held by the smallest id. Each class lists its shingles rarest
first, by a sketch of document counts with ``CELLS`` cells (any order gives the same links; a good one keeps
lists short), and enters the index lists of its prefix.

Answers are derived from those of a similar set. Of the sets in its lists, the one with the lowest hash is a
class's pivot; a class that may be near its pivot by their sketches (at most ``NEAR`` times the difference that a link may
have), or that seems to differ in less than ``ALIKE`` of their sizes from a pivot of more than ``CROWD`` classes, is a member of the pivot's group and is held by its difference from the group's centre, which is the pivot with each shingle
turned that differs in more than half of the members. With weight e = (100 + p) * difference - (100 - p) * size,
two members of a group link if and only if 2 (100 + p) * shared differences >= e + e'. So members with e + e' <= 0
link without a comparison: the answers of one are a stretch of the group's members in order of e, counted by
running sums, never as pairs. All others share a difference, so they meet in lists of differences, rarest
first, and only differences are compared.

What is left are classes of different groups, or far from their pivots. Their lists are cut in blocks of sizes, and
an entry probes only the blocks that its position leaves room for: a pair is found at its first common
shingle, before which nothing is shared, so position i of a set of size s bounds the partner's size, and late
entries skip whole blocks. Pairs that meet must pass a bound of their difference, the odd bits of the sum of
two sketches of the sets, before whole sets are made and compared.

Measured on 0.5 GB of documents (n = 3, p = 90): 6.7 million pairs share a prefix entry; 5.5 million of them have one
pivot, and 91 thousand of the others pass sizes and positions. Lists that are hot for classes without a near pivot in
common (one shingle in the prefixes of very many otherwise different sets) are still met pair by pair, as
far as sizes and positions allow.

Nothing but the sketch goes to the driver. Defined results: null or wordless text has an empty set and is
linked with nothing; fewer words than n make one shingle; null ids give a row with a null component and are
not joined; rows that repeat an id are each judged by their own text, and sets held by one id share its
component and its links; an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import discard, scratch
from .sieve import possibly_in
from .text import shingles_of, slices

#: The proven bound of what is broadcast: 2 bytes a cell.
CELLS, BLOCK = 1 << 22, 1 << 14
NEAR, CROWD, ALIKE, SALTS = 2, 100, 0.7, 64
#: Bits of a sketch of a set: about two a shingle, a power of two within these bounds.
LEAST_BITS, MOST_BITS = 256, 1 << 16


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 16 << 20):
                cells += np.bincount((shingles_of(part.column("text"), n)[0] & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        cells = np.minimum(cells, 255).astype(np.uint8)  # what a task meets more often is frequent in any case
        for at in range(0, CELLS, BLOCK):
            block = cells[at : at + BLOCK]
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["at", "counts"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}  # at most CELLS / BLOCK blocks
    for batch in batches:
        for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[at] = sums.get(at, 0) + np.frombuffer(counts, np.uint8).astype(np.uint32)
    for at, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.minimum(total, 65535).astype("<u2").tobytes()], pa.binary())], ["at", "counts"])


def cell_counts(texts: DataFrame, n: int) -> np.ndarray:
    """Documents per cell, roughly where a cell is full. texts: one column, text."""
    merged = texts.mapInArrow(_count(n), "at int, counts binary").repartition("at").mapInArrow(_merge, "at int, counts binary")
    cells = np.zeros(CELLS, np.uint16)
    for at, counts in merged.toLocalIterator():
        cells[at : at + BLOCK] = np.frombuffer(counts, "<u2")
    return cells


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values.view(np.int64)))


def _odd_bits(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A sketch per set: bit k is odd if an odd number of its hashes fall on k. Sketches of two sets differ in at most as many bits as the sets in shingles."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64), LEAST_BITS, MOST_BITS)
    ends = np.cumsum(bits)
    at = np.repeat(ends - bits, sizes) + ((hashes >> np.uint64(24)).astype(np.int64) & np.repeat(bits - 1, sizes))
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(bool), bitorder="little").tobytes()
    return [packed[(e - n) // 8 : e // 8] for e, n in zip(ends.tolist(), bits.tolist(), strict=True)]


def _odd_between(a: bytes, b: bytes) -> tuple[int, int]:
    """(odd bits of two sketches' sum, a lower bound of the symmetric difference of their sets; bits of the shorter)."""
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    one, two, n = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(y)
    while n > len(x):  # a longer sketch folds to a shorter one
        n //= 2
        two = (two >> (8 * n)) ^ (two & ((1 << (8 * n)) - 1))
    return (one ^ two).bit_count(), 8 * n


def _alike(odd: int, bits: int, sizes: int) -> bool:
    """Whether two sets seem to differ in less than ALIKE of their sizes, by what so many odd bits are expected of."""
    return 2 * odd < bits and -math.log(1 - 2 * odd / bits) * bits / 2 < ALIKE * sizes


def shingle_sets(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size, d1, d2 (identity of the set), prefix (rarest first) and sketch, one row per row of docs."""
    texts = _texts(docs, id_col, text_col)
    counts = docs.sparkSession.sparkContext.broadcast(cell_counts(texts.select("text"), n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = counts.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, sizes = shingles_of(part.column("text"), n)
                ends = np.cumsum(sizes)
                prefixes, lengths = [], []
                for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
                    row = hashes[end - size : end]
                    keep = size - -(-size * percent // 100) + 1 if size else 0
                    order = np.lexsort((row, rank[(row & np.uint64(CELLS - 1)).astype(np.int64)]))[:keep]
                    prefixes.append(row[order])
                    lengths.append(keep)
                flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint64)
                seeds = (hashlib.blake2b(hashes[end - size : end].tobytes(), digest_size=16).digest() for end, size in zip(ends.tolist(), sizes.tolist(), strict=True))
                digests = np.frombuffer(b"".join(seeds), np.int64).reshape(-1, 2)
                prefix = _lists(flat, np.array(lengths, np.int64))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), prefix, pa.array(_odd_bits(hashes, sizes), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "d1", "d2", "prefix", "sketch"])

    return texts.mapInArrow(run, "doc_id long, size long, d1 long, d2 long, prefix array<long>, sketch binary")


def possible(pairs: DataFrame, classes: DataFrame, percent: int, times: int = 1) -> DataFrame:
    """The pairs a, b whose sketches allow at most times the difference that a link may have; of pairs with a true column crowd, those that seem alike too."""
    flagged = pairs if "crowd" in pairs.columns else pairs.withColumn("crowd", F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for x, y, sizes, crowd in zip(*(batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "sizes", "crowd")), strict=True):
                odd, bits = _odd_between(x, y)
                fits.append(odd * (100 + percent) <= times * (100 - percent) * sizes or (crowd and _alike(odd, bits, sizes)))
            yield batch.select(["a", "b", "crowd"]).filter(pa.array(fits, pa.bool_()))

    a = classes.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a"), F.col("size").alias("size_a"))
    b = classes.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b"), F.col("size").alias("size_b"))
    met = flagged.join(a, "a").join(b, "b").select("a", "b", "sketch_a", "sketch_b", (F.col("size_a") + F.col("size_b")).alias("sizes"), "crowd")
    return met.mapInArrow(run, "a long, b long, crowd boolean").distinct()


def differences(pairs: DataFrame, texts: DataFrame, n: int, percent: int, times: int = 1) -> DataFrame:
    """a, b, size_a, size_b and diff (shingles of one of the two) of the pairs with at most times the difference that a link may have, and of those with a true crowd.

    Texts are shuffled rather than sets, which are longer, and only those that a pair names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", 1 << 20):
                a, sizes_a = shingles_of(part.column("text_a"), n)
                b, sizes_b = shingles_of(part.column("text_b"), n)
                ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
                diffs = [np.setxor1d(a[i - s : i], b[j - t : j], assume_unique=True) for i, s, j, t in zip(ends_a, sizes_a, ends_b, sizes_b, strict=True)]
                lengths = np.array([len(d) for d in diffs], np.int64)
                flat = np.concatenate(diffs) if diffs else np.empty(0, np.uint64)
                columns = [part.column("a"), part.column("b"), pa.array(sizes_a, pa.int32()), pa.array(sizes_b, pa.int32()), _lists(flat, lengths)]
                fits = lengths * (100 + percent) <= times * (100 - percent) * (sizes_a + sizes_b)
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "size_a", "size_b", "diff"]).filter(pa.array(fits | np.asarray(part.column("crowd"))))

    named = possibly_in(texts, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), "doc_id")
    own = named.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = named.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "crowd", "text_a", "text_b").mapInArrow(run, "a long, b long, size_a int, size_b int, diff array<long>")


SAME = ["size", "d1", "d2"]


@dataclass(frozen=True)
class _Joined:
    table: DataFrame  # shingle_sets
    classes: DataFrame
    members: DataFrame  # home, rep, size, diff (from the centre) and e
    within: DataFrame  # a, b: links of one group that need a shared difference
    across: DataFrame  # a, b: links of no one group

    def stars(self) -> DataFrame:
        """Links a, b that join the members of a group which link without a shared difference: all with the one of lowest e."""
        low = self.members.groupBy("home").agg(F.min(F.struct("e", "rep")).alias("low"))
        return self.members.join(low, "home").where((F.col("rep") != F.col("low.rep")) & (F.col("e") + F.col("low.e") <= 0)).select(F.col("rep").alias("a"), F.col("low.rep").alias("b"))

    def labels(self) -> DataFrame:
        return components(self.stars().unionByName(self.within).unionByName(self.across))


def _joined(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> _Joined:
    texts = _texts(docs, id_col, text_col)
    sets = scratch(shingle_sets(docs, n, percent, id_col, text_col), "prefixes")
    whole = sets.where("doc_id is not null and size > 0").groupBy(*SAME).agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
    whole, table = scratch(whole, "whole"), scratch(sets.select("doc_id", *SAME), "sets")
    discard(sets)  # the prefixes are long, and are needed no more than once
    classes = scratch(whole.drop("prefix"), "classes")
    entries = whole.select("rep", F.col("size").cast("int").alias("size"), F.posexplode("prefix").alias("pos", "token"))
    several = classes.groupBy("rep").count().where("count > 1").select("rep", F.lit(True).alias("many"))  # ids that hold more than one set are no pivots and have none
    if several.isEmpty():
        entries = entries.repartition("token").withColumn("order", F.xxhash64("rep"))  # one to one for longs
    else:
        entries = entries.join(several, "rep", "left").repartition("token").withColumn("order", F.when(F.col("many").isNull(), F.xxhash64("rep"))).drop("many")
    met = entries.groupBy("token").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.min("order").alias("lead")).where("low <> high").drop("low", "high")
    lists = scratch(entries.join(met, "token"), "lists")
    discard(whole)

    members = _members(lists, classes, texts, n, percent)
    within = scratch(_within(members, percent), "within")
    apart = scratch(possible(_apart(lists, members, percent), classes, percent), "pairs")
    across = differences(apart, texts, n, percent).select("a", "b").distinct()
    return _Joined(table, classes, members, within, scratch(across, "across"))


def _members(lists: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """home, rep, size, diff, e: the classes near their pivots, by their differences from the centre of their group."""
    pivots = lists.where("order is not null").groupBy("rep").agg(F.min("lead").alias("lead"))
    homes = scratch(pivots.join(classes.select(F.col("rep").alias("home"), F.xxhash64("rep").alias("lead")), "lead").select("rep", "home"), "homes")
    away = homes.where("rep <> home").select(F.col("rep").alias("a"), F.col("home").alias("b"))
    crowds = away.groupBy("b").count().where(F.col("count") > CROWD).select("b", F.lit(True).alias("crowd"))
    away = away.join(crowds, "b", "left").select("a", "b", F.coalesce("crowd", F.lit(False)).alias("crowd"))
    close = scratch(possible(away, classes, percent, NEAR), "pairs")
    near = differences(close, texts, n, percent, NEAR).select(F.col("b").alias("home"), F.col("a").alias("rep"), F.col("size_a").alias("size"), "diff")
    own = homes.where("rep = home").join(classes.select("rep", F.col("size").cast("int").alias("size")), "rep")
    members = scratch(near.unionByName(own.select("home", "rep", "size", F.array().cast("array<long>").alias("diff"))), "members")

    # the centre: what differs in more than half of the members is turned
    sizes = members.groupBy("home").agg(F.count("*").alias("m")).where("m > 1").select("home", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    counts = members.select("home", F.explode("diff").alias("token")).groupBy("home", "token").agg(F.count("*").alias("c")).where("c > 1").withColumn("salt", F.pmod("token", F.lit(SALTS)))
    turned = counts.join(sizes, ["home", "salt"]).where("2 * c > m").select("home", "token").repartition("home").groupBy("home").agg(F.collect_list("token").alias("turned"))
    moved = members.join(turned, "home", "left").withColumn("turned", F.coalesce("turned", F.array().cast("array<long>")))
    moved = moved.select("home", "rep", "size", F.concat(F.array_except("diff", "turned"), F.array_except("turned", "diff")).alias("diff"))
    return scratch(moved.withColumn("e", ((100 + percent) * F.size("diff") - (100 - percent) * F.col("size")).cast("long")), "moved")


def _within(members: DataFrame, percent: int) -> DataFrame:
    """a, b: links of members of one group with e + e' > 0, which share a difference."""
    parts = members.select("home", "rep", "e", "size", F.explode("diff").alias("token"))
    shared = parts.groupBy("home", "token").agg(F.count("*").alias("c"), F.max("e").alias("most")).where("c > 1 and most > 0").drop("most")
    least = members.groupBy("home").agg(F.min("e").alias("least"))
    asked = F.greatest(F.lit(1), F.ceil((F.col("e") + F.col("least")) / (2 * (100 + percent))))
    own = Window.partitionBy("home", "rep")  # at most a set's differences
    ranked = parts.join(shared, ["home", "token"]).withColumn("rest", F.count("*").over(own) - F.row_number().over(own.orderBy("c", "token")))
    first = ranked.join(least, "home").where(F.col("rest") + 1 >= asked).select("home", "token", "rep", "e", "size", "rest")
    others = first.select("home", "token", *[F.col(c).alias(f"{c}_b") for c in ("rep", "e", "size", "rest")])
    # at its first common difference a pair has at most the rest of either to share
    fits = 2 * (100 + percent) * (1 + F.least("rest", "rest_b")) >= F.col("e") + F.col("e_b")
    sizes = (F.col("size_b") * 100 >= F.col("size") * percent) & (F.col("size") * 100 >= F.col("size_b") * percent)
    met = first.join(others, ["home", "token"]).where((F.col("rep") > F.col("rep_b")) & (F.col("e") + F.col("e_b") > 0) & fits & sizes).select("home", "rep", "rep_b").distinct()
    a, b = members.select("home", "rep", "e", "diff"), members.select("home", F.col("rep").alias("rep_b"), F.col("e").alias("e_b"), F.col("diff").alias("diff_b"))
    links = 2 * (100 + percent) * F.size(F.array_intersect("diff", "diff_b")) >= F.col("e") + F.col("e_b")
    return met.join(a, ["home", "rep"]).join(b, ["home", "rep_b"]).where(links).select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))


def _apart(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of no one group whose sizes and positions of a shared shingle leave the overlap that is asked for."""
    placed = lists.select("token", "rep", "size", "pos").join(members.select("rep", "home"), "rep", "left")
    mixed = placed.groupBy("token").agg(F.min("home").alias("low"), F.max("home").alias("high"), F.count("home").alias("near"), F.count("*").alias("n")).where("low <> high or near < n").select("token")
    # at its first common shingle a pair shares nothing before, so the partner has at most this size
    reach = F.floor((F.col("size") - F.col("pos")) * (100 + percent) / percent) - F.col("size")
    left = scratch(placed.join(mixed, "token", "left_semi").withColumn("reach", reach.cast("int")), "left")
    width = 2 / np.log(100 / min(percent, 99))
    block = lambda size: F.floor(F.log(size.cast("double")) * width).cast("int")
    least, most = F.ceil(F.col("size") * percent / 100), F.least("size", "reach")
    probe = left.where(least <= most).withColumn("block", F.explode(F.sequence(block(least), block(most))))
    others = left.where("reach >= size").select("token", block(F.col("size")).alias("block"), *[F.col(c).alias(f"{c}_b") for c in ("rep", "size", "reach", "home")])
    order = F.struct("size", "rep") > F.struct("size_b", "rep_b")
    fits = (F.col("size_b") >= least) & (F.col("size_b") <= F.col("reach")) & (F.col("size") <= F.col("reach_b"))
    met = probe.join(others, ["token", "block"]).where(order & fits & F.coalesce(F.col("home") != F.col("home_b"), F.lit(True)) & (F.col("rep") != F.col("rep_b")))
    return met.select(F.greatest("rep", "rep_b").alias("a"), F.least("rep", "rep_b").alias("b")).distinct()


def _with_classes(joined: _Joined, values: DataFrame) -> DataFrame:
    """The table, one row per row of docs, with rep of its class and the columns of values, which has one row per rep; null where there is none."""
    known = joined.classes.select(*[F.col(c).alias(f"{c}_k") for c in SAME], "rep").join(values, "rep", "left")
    met = (F.col("size") == F.col("size_k")) & (F.col("d1") == F.col("d1_k")) & (F.col("d2") == F.col("d2_k"))
    return joined.table.select("doc_id", *SAME).join(known, met, "left")


def _held() -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of docs."""
    joined = _joined(docs, n, percent, id_col, text_col)
    return _with_classes(joined, joined.labels().withColumnRenamed("node", "rep")).select("doc_id", F.col("size").alias("n_shingles"), _held())


def jaccard_links(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a and b, a > b: every link between the smallest ids of two classes, once; as many rows as there are links. Rows with equal sets are one class and give no link."""
    joined = _joined(docs, n, percent, id_col, text_col)
    others = joined.members.select("home", F.col("rep").alias("rep_b"), F.col("e").alias("e_b"))
    certain = joined.members.join(others, "home").where("rep > rep_b and e + e_b <= 0").select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))
    return certain.unionByName(joined.within).unionByName(joined.across)


def _certain(members: DataFrame) -> DataFrame:
    """node and n, the links of a member that need no shared difference: members of its group up to an e, by running sums over the distinct e of a group."""
    by_e = members.groupBy("home", "e").agg(F.count("*").alias("n"))
    asks = by_e.select("home", (-F.col("e")).alias("at"), F.col("e").alias("e"), F.lit(0).cast("long").alias("n"))
    rows = by_e.select("home", F.col("e").alias("at"), F.lit(None).cast("long").alias("e"), "n").unionByName(asks)
    so_far = Window.partitionBy("home").orderBy(F.col("at"), F.col("e").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = rows.withColumn("upto", F.sum("n").over(so_far)).where("e is not null").select("home", "e", "upto")
    itself = F.when(F.col("e") <= 0, 1).otherwise(0)
    return members.select("home", "rep", "e").join(known, ["home", "e"]).select(F.col("rep").alias("node"), (F.col("upto") - itself).alias("n"))


def jaccard_answers(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other classes that the document's class links with), one row per row of docs."""
    joined = _joined(docs, n, percent, id_col, text_col)
    single = joined.within.unionByName(joined.across).select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n"))
    counts = _certain(joined.members).unionByName(single).groupBy("node").agg(F.sum("n").alias("n"))
    values = joined.labels().join(counts, "node", "full_outer").withColumnRenamed("node", "rep")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n", F.lit(0))).cast("long").alias("n_links")
    return _with_classes(joined, values).select("doc_id", F.col("size").alias("n_shingles"), _held(), n_links)


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, that of the smallest id, null ids last. Rows are numbered once, so that rows without an id and rows that repeat one are judged each on their own; columns may have any name."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).select(F.monotonically_increasing_id().alias("row_no"), F.col(names[docs.columns.index(id_col)]).cast("long").alias("id"), F.col(names[docs.columns.index(text_col)]).cast("string").alias("words"), *names)
    rows = scratch(rows, "numbered")
    parts = jaccard_components(rows, n, percent, "row_no", "words").select(F.col("doc_id").alias("row_no"), "component_id")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_no"))
    stays = parts.join(rows.select("row_no", "id"), "row_no").groupBy("component_id").agg(first.alias("first")).select(F.col("first.row_no").alias("row_no"))
    return rows.join(stays, "row_no", "left_semi").select(*names).toDF(*docs.columns)
