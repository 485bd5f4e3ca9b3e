"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier line, by (doc_id, position), equals it or is one character edit away. Equal lines
meet by hash. For the rest, a line and its neighbour share all in front of the middle of the shorter one or all
behind it, and the edit stands in the other part. So each line enters four groups, by its length and the hash of
what it may share: as one of equal length or the shorter one (role S), and as the longer one (role L). Only groups
with two lines in role S, or lines in both roles, go on, with the other part as their text, which is halved again
in the same way until it has at most ``STRETCH`` characters. Then the deletion variants are emitted as hashed keys:
(position, variant) meets lines that differ in that character, and a variant of a line in role L meets the line
in role S that it is. A line of n characters costs n log n, not n * n. In the first kind of group all lines are
neighbours of its earliest, in the second all are neighbours of the one in role S, so pairs grow with the lines of
a group and not with their square, and each pair is verified by the edit distance of whole lines.

The text itself is shuffled once, to join each document with the positions it keeps; before that only hashes
and ids are, and the lines with possible neighbours, picked by a bitmap of ``sieve.BITMAP_BITS`` bits, which is
the proven bound of what is broadcast (8 MB, 17 as a hashed table).

Defined results: lines without a word stay and are compared with nothing; null text stays null; null doc_id
comes last; rows equal in id and text are one document and all get its result; a document without a line
left has an empty text, or is left out by ``deduplicated``; an empty table gives an empty result. Columns of docs
may have any name; own columns named n_lines or n_kept are replaced by ``line_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import scratch
from .sieve import possibly_in

WORDED = r"[^\x20\x09-\x0D]"
STRETCH = 16
LINE = ["h1", "h2"]


def _hash(*parts: Column | str) -> Column:
    return F.xxhash64(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a word: its place and the line."""
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    base = base.select("doc_id", F.xxhash64(F.lit("doc"), "text").alias("doc_hash"), "text")
    return base.select("doc_id", "doc_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(F.col("line").rlike(WORDED))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("doc_hash").alias("doc_hash"), F.col("pos").alias("pos"))


def _sides(part: Column, m: Column, longer: bool) -> tuple[tuple[Column, Column, Column], ...]:
    """(what is shared, the other part, the other part's length in role S), for the front and for the back; part has m characters, in role L one more."""
    f = F.floor(m / 2).cast("int")
    extra = 1 if longer else 0
    front = (F.substring(part, F.lit(1), f), F.substring(part, f + 1, m - f + extra), m - f)
    back = (F.substring(part, f + 1 + extra, m - f), F.substring(part, F.lit(1), f + extra), f)
    return front, back


def _keys(line: Column) -> list[Column]:
    """The groups of a line: front and back in role S, front and back in role L."""
    n = F.char_length(line)
    return [_hash(side, m, shared) for longer, m in ((False, n), (True, n - 1)) for side, (shared, _, _) in zip("pq", _sides(line, m, longer), strict=True)]


def distinct_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """h1, h2 (a line's 128-bit identity), first (place of its earliest copy) and k0 to k3 (its groups)."""
    line = F.col("line")
    hashed = _rows(docs, id_col, text_col).select(_hash("1", line).alias("h1"), _hash("2", line).alias("h2"), _place().alias("place"), *[key.alias(f"k{i}") for i, key in enumerate(_keys(line))])
    return hashed.groupBy(*LINE).agg(F.min("place").alias("first"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(4)])


def _live(rows: DataFrame, by: str, ids: list[str]) -> DataFrame:
    """The rows whose group has lines in both roles, or, for role S, two of them. rows: by, longer (role L) and ids."""
    short = [F.when(~F.col("longer"), F.col(c)) for c in ids]
    ends = [f(x).alias(f"{name}{k}") for k, x in enumerate(short) for f, name in ((F.min, "low"), (F.max, "high"))]
    groups = rows.groupBy(by).agg(*ends, F.bool_or("longer").alias("longs"))
    several = F.lit(False)
    for k in range(len(ids)):
        several |= F.col(f"low{k}") != F.col(f"high{k}")
    groups = groups.where(F.col("low0").isNotNull() & (F.col("longs") | several)).select(by, "longs", several.alias("several"))
    return rows.join(groups, by).where(F.col("longer") | F.col("longs") | F.col("several")).drop("longs", "several")


def possible_neighbours(lines: DataFrame) -> DataFrame:
    """h1, key, side (0 front, 1 back), longer: the groups in which a line may have a neighbour."""
    entries = F.array(*[F.struct(F.col(f"k{i}").alias("key"), F.lit(i % 2).cast("byte").alias("side"), F.lit(i > 1).alias("longer")) for i in range(4)])
    return _live(lines.select("h1", F.explode(entries).alias("x")).select("h1", "x.*").repartition("key"), "key", ["h1"])


def _parts(rows: DataFrame) -> DataFrame:
    """LINE, first, key, longer, m, part: the part in which a line and a neighbour of its group differ. rows: LINE, first, line, key, side, longer."""
    n = F.char_length("line")
    short, long = _sides(F.col("line"), n, False), _sides(F.col("line"), n - 1, True)
    pick = lambda which: F.when(F.col("longer"), F.when(F.col("side") == 0, long[0][which]).otherwise(long[1][which])).otherwise(F.when(F.col("side") == 0, short[0][which]).otherwise(short[1][which]))
    return rows.select(*LINE, "first", "key", "longer", pick(2).alias("m"), pick(1).alias("part"))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows with a part of more than STRETCH characters as two with half of it, those of groups that can still hold neighbours."""
    done, todo = rows.where(F.col("m") <= STRETCH), rows.where(F.col("m") > STRETCH)
    short, long = _sides(F.col("part"), F.col("m"), False), _sides(F.col("part"), F.col("m"), True)

    def half(k: int) -> Column:
        choose = lambda which: F.when(F.col("longer"), long[k][which]).otherwise(short[k][which])
        return F.struct(_hash("pq"[k], F.col("key"), F.col("m"), choose(0)).alias("key"), choose(2).alias("m"), choose(1).alias("part"))

    split = todo.select(*LINE, "first", "longer", F.explode(F.array(half(0), half(1))).alias("x"))
    live = _live(split.select(*LINE, "first", F.col("x.key").alias("key"), "longer", F.col("x.m").alias("m"), F.col("x.part").alias("part")), "key", LINE)
    return done.unionByName(live.select(*done.columns))


def neighbour_pairs(parts: DataFrame) -> DataFrame:
    """LINE, first, near_h1, near_h2, near_first: a line and an earlier one that is its neighbour by the variants of their parts, of at most STRETCH characters."""
    part, i = F.col("part"), F.col("i")
    n = F.char_length("part")
    rows = parts.select(*LINE, "first", "key", "longer", "part", F.explode(F.sequence(F.lit(0), n)).alias("i")).where("i > 0 or not longer")
    without = F.concat(F.substring(part, F.lit(1), i - 1), F.substring(part, i + 1, n))
    # role 0: one of the lines that differ at i; 1: a line less one character; 2: a whole line
    kind = F.when(i == 0, 2).when(F.col("longer"), 1).otherwise(0)
    key = F.when(i == 0, _hash("whole", F.col("key"), part)).when(F.col("longer"), _hash("whole", F.col("key"), without)).otherwise(_hash("at", F.col("key"), i, without))
    keyed = rows.select(*LINE, "first", key.alias("key"), kind.alias("role")).distinct().repartition("key")
    order = F.struct("first", *LINE)
    lead = keyed.groupBy("key").agg(F.min(F.when(F.col("role") != 1, order)).alias("head"), F.min(F.when(F.col("role") == 1, order)).alias("shorter"), F.count("*").alias("n")).where("n > 1")
    near = F.when(F.col("role") == 2, F.col("shorter")).otherwise(F.col("head"))
    pairs = keyed.join(lead, "key").select(*LINE, "first", near.alias("near")).where("near.first < first")
    return pairs.select(*LINE, "first", F.col("near.h1").alias("near_h1"), F.col("near.h2").alias("near_h2")).distinct()


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two strings are at most one character edit apart: what stands behind the first difference is compared, found by halving steps. Spark's levenshtein is quadratic in long lines."""
    n, m = F.char_length(a), F.char_length(b)
    steps = F.transform(F.sequence(F.lit(31), F.lit(1), F.lit(-1)), lambda j: F.pow(F.lit(2.0), j - 1).cast("int"))
    reach = F.least(n, m)
    same = F.aggregate(steps, F.lit(0), lambda k, step: F.when((step <= reach - k) & (F.substring(a, k + 1, step) == F.substring(b, k + 1, step)), k + step).otherwise(k))

    def rest(k: Column) -> Column:
        behind = lambda x, at: F.substring(x, at, F.greatest(n, m))
        return F.when(n == m, behind(a, k + 2) == behind(b, k + 2)).when(n == m + 1, behind(a, k + 2) == behind(b, k + 1)).when(m == n + 1, behind(a, k + 1) == behind(b, k + 2)).otherwise(F.lit(False))

    return F.get(F.transform(F.array(same), rest), F.lit(0))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, doc_hash and the positions of the lines with a word that a document keeps."""
    lines = scratch(distinct_lines(docs, id_col, text_col), "lines")
    may = scratch(possible_neighbours(lines), "may")
    found = _rows(docs, id_col, text_col).select(_hash("1", F.col("line")).alias("h1"), _hash("2", F.col("line")).alias("h2"), "line")
    found = possibly_in(found, may, "h1").groupBy(*LINE).agg(F.first("line").alias("line"))
    texts = scratch(found.join(possibly_in(lines.select(*LINE, "first"), may, "h1"), LINE), "texts")
    parts = scratch(_parts(texts.join(may, "h1")), "parts")
    longest = parts.agg(F.max("m").alias("m")).first()["m"] or 0
    while longest > STRETCH:  # as often as halving the longest part asks for
        parts, longest = scratch(_halved(parts), "parts"), (longest + 1) // 2
    pairs = neighbour_pairs(parts)
    near = texts.select(F.col("h1").alias("near_h1"), F.col("h2").alias("near_h2"), F.col("line").alias("near_line"))
    verified = pairs.join(texts.select(*LINE, "line"), LINE).join(near, ["near_h1", "near_h2"]).where(within_one_edit(F.col("line"), F.col("near_line")))
    gone = scratch(verified.select(*LINE).distinct(), "gone")
    stay = lines.select(*LINE, "first").join(gone, LINE, "left_anti")
    return stay.groupBy(F.col("first.doc_id").alias("kept_id"), F.col("first.doc_hash").alias("kept_hash")).agg(F.collect_set("first.pos").alias("kept"))


def _cleared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of docs as c0, c1, ... with the text cleared, and n_lines and n_kept."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc, words = F.col(names[docs.columns.index(id_col)]).cast("long"), names[docs.columns.index(text_col)]
    kept = kept_lines(docs, id_col, text_col)
    rows = docs.toDF(*names).select("*", doc.alias("doc"), F.xxhash64(F.lit("doc"), F.col(words).cast("string")).alias("doc_hash"))
    joined = rows.join(kept, F.col("doc").eqNullSafe(F.col("kept_id")) & (F.col("doc_hash") == F.col("kept_hash")), "left")
    places = F.coalesce(F.col("kept"), F.array().cast("array<int>"))

    def left(parts: Column) -> Column:
        """The lines that stay, in their order: those kept and those without a word."""
        wordless = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: ~F.get(parts, i).rlike(WORDED))
        return F.array_join(F.transform(F.array_sort(F.concat(wordless, places)), lambda i: F.get(parts, i)), "\n")

    split = F.split(F.col(words).cast("string"), "\n", -1)
    text = F.when(F.col(words).isNotNull(), F.get(F.transform(F.array(split), left), F.lit(0)))  # bound once: a split within a lambda would be made for each line
    n_lines = F.when(F.col(words).isNull(), 0).otherwise(F.size(F.filter(split, lambda line: line.rlike(WORDED))))
    return joined.select(*[text.alias(c) if c == words else F.col(c) for c in names], n_lines.cast("long").alias("n_lines"), F.size(places).cast("long").alias("n_kept"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col cleared of repeated lines, and n_lines and n_kept: lines with a word before and after."""
    out = _cleared(docs, id_col, text_col)
    names = [(F.col(f"c{k}"), c) for k, c in enumerate(docs.columns) if c not in ("n_lines", "n_kept")]
    return out.select(*[x.alias(c) for x, c in names], "n_lines", "n_kept")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without repeated lines and without the documents of which no line with a word is left."""
    left = _cleared(docs, id_col, text_col).where("n_lines = 0 or n_kept > 0")
    return left.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
