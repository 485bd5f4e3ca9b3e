"""URL filters against dated lists, by a temporal join.

A list is a log of dated entries: from its date on, an entry blocks, allows or lifts a pattern, which is a
host with all below it, or a host and the start of a path. Per pattern, each entry is valid until the next
one, so the log becomes intervals. Every capture emits the patterns that cover it (host suffixes and path
prefixes), meets the intervals of equal pattern that hold at its fetch time, and takes the most specific
entry active then; blocking wins over allowing at one specificity.

Entries of one pattern and date: the strictest counts (block, then allow, then lift). Defined results: a
null or unreadable address is kept with reason 'no address', a null fetch time with 'no date'; an empty
list keeps all; rows that repeat are judged each on their own; an empty table gives an empty result. All
columns of captures are kept, whatever their names, and verdict columns added (own columns of their names are
replaced). Each pair of address and fetch time is judged once and its verdict joined back, so nothing depends on
row numbers. An address emits only patterns as deep as the list's deepest, and those that may be in the list by a
bitmap of ``sieve.BITMAP_BITS`` bits; no other side is broadcast unless Spark measures it as small, and a hot host
is split by the join's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sieve import possibly_in

VERDICT = ("kept", "reason", "pattern", "since")
_STRICTNESS = {"block": 3, "allow": 2, "lift": 1}


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_replace(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1), r"\.$", "")), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))


def patterns_of(url: Column, most_labels: int, most_segments: int) -> Column:
    """array<struct<pattern, rank>>: what covers an address, rank higher for the more specific, up to so many labels of its host and segments of its path.

    Hosts rank by their labels, paths of the full host above them by their segments.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most_labels))), lambda k: F.struct(F.array_join(F.slice(labels, n - k + 1, k), ".").alias("pattern"), k.alias("rank")))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    m = F.least(F.size(segments), F.lit(most_segments))
    paths = F.transform(F.sequence(F.lit(1), m), lambda i: F.struct(F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("pattern"), (n + i).alias("rank")))
    none = F.array().cast("array<struct<pattern:string,rank:int>>")
    return F.when(host != "", F.concat(hosts if most_labels else none, F.when(m > 0, paths).otherwise(none)))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, since, until (null: open) from a log with pattern, action and entry_date."""
    strict = F.create_map(*[F.lit(x) for pair in _STRICTNESS.items() for x in pair])
    clean = entries.where("pattern is not null and entry_date is not null and action in ('block', 'allow', 'lift')").select(F.regexp_replace(F.trim("pattern"), "/+$", "").alias("pattern"), F.col("entry_date").cast("timestamp").alias("since"), strict[F.col("action")].alias("strict"))
    per_date = clean.groupBy("pattern", "since").agg(F.max("strict").alias("strict"))
    following = F.lead("since").over(Window.partitionBy("pattern").orderBy("since"))
    action = F.when(F.col("strict") == 3, "block").when(F.col("strict") == 2, "allow").otherwise("lift")
    return per_date.select("pattern", action.alias("action"), "since", following.alias("until")).where("action <> 'lift'")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """captures with kept, reason, pattern and since."""
    names = [f"c{k}" for k in range(len(captures.columns))]
    address, time = (F.col(names[captures.columns.index(c)]) for c in (url_col, time_col))
    rows = captures.toDF(*names).select("*", address.cast("string").alias("address"), time.cast("timestamp").alias("at"))
    list_ = intervals(entries).withColumn("key", F.xxhash64("pattern"))
    host = F.substring_index("pattern", "/", 1)
    deepest = list_.agg(F.max(F.size(F.split(host, r"\."))).alias("labels"), F.max(F.size(F.split("pattern", "/")) - 1).alias("segments")).first()
    asked = rows.where("address is not null and at is not null").select("address", "at").distinct()
    keys = asked.select("address", "at", F.explode(patterns_of(F.col("address"), deepest["labels"] or 0, deepest["segments"] or 0)).alias("p"))
    keys = possibly_in(keys.select("address", "at", F.col("p.pattern").alias("covers"), F.col("p.rank").alias("rank"), F.xxhash64("p.pattern").alias("key")), list_, "key")
    active = (F.col("covers") == F.col("pattern")) & (F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    best = keys.drop("key").join(list_.drop("key"), active).groupBy("address", "at").agg(F.max(F.struct("rank", "action", "pattern", "since")).alias("hit"))
    best = best.select(F.col("address").alias("hit_address"), F.col("at").alias("hit_at"), "hit")
    judged = rows.join(best, (F.col("address") == F.col("hit_address")) & (F.col("at") == F.col("hit_at")), "left")
    reason = F.when(host_of(F.col("address")) == "", "no address").when(F.col("at").isNull(), "no date").when(F.col("hit").isNull(), "unlisted").when(F.col("hit.action") == "block", "blocked").otherwise("allowed")
    own = [F.col(x).alias(c) for x, c in zip(names, captures.columns, strict=True) if c not in VERDICT]
    return judged.select(*own, (reason != "blocked").alias("kept"), reason.alias("reason"), F.col("hit.pattern").alias("pattern"), F.col("hit.since").alias("since"))
