"""Chat formatting by quotation linking.

A line's quote level is the number of its leading '>' marks; lines of a level above 0 that say something
are quoted passages. Passages are normalised (marks off, lower case, one space for each run of white space)
and hashed, and meet the unquoted lines of earlier messages of the same conversation by hash, whole line by whole
line: each names the latest earlier message that says it. A message answers the one named by most of its quoted lines
of the lowest level that names any, the later one on a tie; a deeper level gives the answered message's ancestor, which
is taken instead. A message without a quote that is found answers the message before it. Replies then form
a tree, and messages are ordered along it, a reply after what it answers, siblings by turn.

A quoted line is matched with one message only, so matches grow with the lines, however often one is said. Depth and
place come from the tour around each tree (into a message, through its replies, out of it), ranked by pointers that double in
length: a conversation of n messages is in log2(2 n) joins of at most 2 n rows each, and a longer one beside it adds none.
Neighbours in a conversation are found within ``STRIDE`` turns and then over strides, so no conversation is ever sorted in one task.

Defined results: null text is empty and answers the message before it; null conversations or turns are
left out; of several rows with one conversation and turn the smallest (role, text) stays; quotes of lines that
nobody wrote are removed and link nothing; an empty table gives an empty result; only the four columns named
are read. Only built-in functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import scratch

MARKS = r"^[\x20\x09]*+>[\x20\x09>]*+"
STRIDE = 4096


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"[\x20\x09-\x0D]+", " "))


def parsed(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, own (text without quoted lines) and lines (level and hash of each line that says something)."""
    rows = messages.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.struct(F.col(f"`{role_col}`").alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("said"))
    one = rows.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("said").alias("said"))
    parts = F.split("said.text", "\n", -1)
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))
    lines = F.transform(parts, lambda x: F.struct(level(x).alias("level"), normal(x).alias("norm")))
    hashed = F.transform(F.filter(lines, lambda x: x["norm"] != ""), lambda x: F.struct(x["level"].alias("level"), F.xxhash64(F.lit("line"), x["norm"]).alias("h1"), F.xxhash64(F.lit("more"), x["norm"]).alias("h2")))
    own = F.trim(F.array_join(F.filter(parts, lambda x: level(x) == 0), "\n"), F.lit(" \t\n\x0b\x0c\r"))
    return one.select("conv_id", "turn", F.col("said.role").alias("role"), own.alias("own"), hashed.alias("lines"))


def _latest_before(rows: DataFrame, keys: list[str], at: str, value: str, name: str) -> DataFrame:
    """rows with name: the largest value among rows of the same keys, none null, whose at is smaller."""
    rows = rows.withColumn("stride", F.floor(F.col(at) / STRIDE))
    within = F.max(value).over(Window.partitionBy(*keys, "stride").orderBy(at).rangeBetween(Window.unboundedPreceding, -1))
    earlier = F.max("most").over(Window.partitionBy(*keys).orderBy("stride").rowsBetween(Window.unboundedPreceding, -1))
    strides = rows.groupBy(*keys, "stride").agg(F.max(value).alias("most")).withColumn("earlier", earlier).drop("most")
    found = rows.withColumn("within", within).join(strides, [*keys, "stride"])
    return found.withColumn(name, F.coalesce("within", "earlier")).drop("within", "earlier", "stride")


def reply_links(table: DataFrame) -> DataFrame:
    """conv_id, turn, parent (turn answered; null: none), quoted (lines found), from the parsed and written messages."""
    lines = table.select("conv_id", "turn", F.explode(F.array_distinct("lines")).alias("x")).select("conv_id", "turn", "x.*")
    line = ["conv_id", "h1", "h2"]
    quotes = lines.where("level > 0").select(*line, F.col("turn").alias("at"), "level", F.lit(None).cast("long").alias("said"))
    says = lines.where("level = 0").join(quotes.select(*line).distinct(), line, "left_semi").select(*line, F.col("turn").alias("at"), "level", F.col("turn").alias("said"))
    found = _latest_before(quotes.unionByName(says), line, "at", "said", "turn").where("level > 0 and turn is not null")
    votes = found.groupBy("conv_id", F.col("at").alias("by"), "level", "turn").agg(F.count("*").alias("n"))
    best = votes.groupBy("conv_id", "by").agg(F.max(F.struct(-F.col("level"), "n", "turn")).alias("best"))
    base = _latest_before(table.select("conv_id", "turn"), ["conv_id"], "turn", "turn", "before")
    joined = base.join(best.withColumnRenamed("by", "turn"), ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", F.coalesce("best.turn", "before").alias("parent"), F.coalesce("best.n", F.lit(0)).cast("long").alias("quoted"))


def placed(links: DataFrame) -> DataFrame:
    """conv_id, turn, depth and place (from 0, in reply order) of conv_id, turn and parent, by ranking the steps of the tour around each tree."""
    node = ["conv_id", "turn"]
    replies = links.where("parent is not null")
    left = _latest_before(replies.select(*node, "parent"), ["conv_id", "parent"], "turn", "turn", "left").select(*node, "left")
    last = replies.groupBy("conv_id", F.col("parent").alias("turn")).agg(F.max("turn").alias("last"))
    tied = links.join(left, node, "left").join(last, node, "left")
    # step out 0 goes into a message, 1 out of it; each points at the step before it
    into = F.struct(F.lit(0).alias("out"), F.coalesce("left", "parent").alias("turn_b"), F.when(F.col("left").isNotNull(), 1).otherwise(0).alias("out_b"), F.lit(1).alias("seen"), F.lit(1).alias("open"))
    outof = F.struct(F.lit(1).alias("out"), F.coalesce("last", "turn").alias("turn_b"), F.when(F.col("last").isNotNull(), 1).otherwise(0).alias("out_b"), F.lit(0).alias("seen"), F.lit(-1).alias("open"))
    length = links.groupBy("conv_id").agg((2 * F.count("*")).alias("tour"))
    exploded = tied.join(length, "conv_id").select(*node, "tour", F.explode(F.array(into, outof)).alias("s"))
    steps = scratch(exploded.select(*node, "tour", "s.out", "s.turn_b", "s.out_b", F.col("s.seen").cast("long").alias("seen"), F.col("s.open").cast("long").alias("open")), "steps")
    done, reach = [], 1
    while True:  # each step has the sums of reach steps up to itself; tours no longer than that are done
        done.append(steps.where(F.col("tour") <= reach))
        going = steps.where(F.col("tour") > reach)
        if going.isEmpty():
            break
        before = going.select("conv_id", F.col("turn").alias("turn_b"), F.col("out").alias("out_b"), F.col("turn_b").alias("turn_c"), F.col("out_b").alias("out_c"), F.col("seen").alias("seen_b"), F.col("open").alias("open_b"))
        sums = [(F.col(c) + F.col(f"{c}_b")).alias(c) for c in ("seen", "open")]
        further = going.where("turn_b is not null").join(before, ["conv_id", "turn_b", "out_b"]).select(*node, "tour", "out", F.col("turn_c").alias("turn_b"), F.col("out_c").alias("out_b"), *sums)
        steps, reach = scratch(further.unionByName(going.where("turn_b is null")), "steps"), 2 * reach
    ranked = reduce(DataFrame.unionByName, done).where("out = 0")
    return ranked.select(*node, (F.col("open") - 1).alias("depth"), (F.col("seen") - 1).alias("place"))


def quotation_links(messages: DataFrame, **columns: str) -> DataFrame:
    """conv_id, turn, role, parent, depth, place (from 0, in reply order), quoted, text (without quotes); one row per message."""
    table = scratch(parsed(messages, **columns), "messages")
    links = scratch(reply_links(table), "replies")
    ranked = links.join(placed(links), ["conv_id", "turn"])
    return ranked.join(table.select("conv_id", "turn", "role", F.col("own").alias("text")), ["conv_id", "turn"]).select("conv_id", "turn", "role", "parent", "depth", "place", "quoted", "text")


def formatted(linked: DataFrame) -> DataFrame:
    """conv_id, leaf and messages (role and content from the root to each message that nobody answers). Rows grow as these lists do."""
    turns = linked.select("conv_id", "turn", "parent", "role", F.col("text").alias("content"))
    leaves = turns.join(turns.select("conv_id", F.col("parent").alias("turn")).where("turn is not null").distinct(), ["conv_id", "turn"], "left_anti")
    on = scratch(leaves.select("conv_id", F.col("turn").alias("leaf"), "turn", F.lit(0).cast("long").alias("up")), "paths")
    jump, length = scratch(turns.select("conv_id", "turn", F.col("parent").alias("to")).where("to is not null"), "jumps"), 1
    while not jump.isEmpty():  # all ancestors within length steps are there; a jump of that length gives as many again
        further = on.join(jump, ["conv_id", "turn"]).select("conv_id", "leaf", F.col("to").alias("turn"), (F.col("up") + length).alias("up"))
        on = scratch(on.unionByName(further), "paths")
        jump = scratch(jump.join(jump.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("then")), ["conv_id", "to"]).select("conv_id", "turn", F.col("then").alias("to")), "jumps")
        length *= 2
    said = F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("pos"), "role", "content")))
    return on.join(turns.drop("parent"), ["conv_id", "turn"]).groupBy("conv_id", "leaf").agg(F.transform(said, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
