"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, jaccard, language, line_dedup, mixing, packing, pseudonyms, quality, quoting, url_filter

#: The query's key; a real one is a secret that the caller keeps.
KEY = "a key for the test tables"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), KEY).select("doc_id", "n_pseudonyms", F.sha2("text", 256).alias("text_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: {docs}: a relation with doc_id, source and text.
MIX_SQL = f"""
WITH sizes AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size FROM {{docs}}),
by_source AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, source_size * {mixing.CAP} AS most, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {mixing.CYCLE} + 1 AS weight FROM by_source),
levels AS (SELECT *, row_number() OVER w AS k,
    (sum(source_size) OVER ())::DOUBLE AS total,
    coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS stopped,
    (sum(weight) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weights
    FROM ranked WINDOW w AS (ORDER BY most::DOUBLE / weight, source NULLS LAST)),
shared AS (SELECT *, (total - stopped) / weights AS level FROM levels),
open_from AS (SELECT min(k) AS k FROM shared WHERE level * weight <= most),
targets AS (SELECT source, n, source_size,
    CASE WHEN k >= (SELECT k FROM open_from) THEN (SELECT level FROM shared WHERE k = (SELECT k FROM open_from)) * weight ELSE most::DOUBLE END AS target,
    ('0x' || substr(md5('{mixing.SEED}|' || coalesce('=' || source, '')), 1, 12))::BIGINT::DOUBLE / {float(1 << 48)} AS shift FROM shared),
placed AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.shift, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT % ceil(t.n / {float(mixing.CHUNK)})::BIGINT AS chunk
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY chunk, CASE WHEN chunk % 2 = 0 THEN size ELSE -size END, doc_id NULLS FIRST) AS place FROM placed),
drawn AS (SELECT *, (floor(place * rate + shift) - floor((place - 1) * rate + shift))::BIGINT AS copies FROM ordered)
"""


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_answers(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(_table(spark, sf_dir, "documents"))
    return language.identify(_table(spark, sf_dir, "pages"), model)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


_OP5_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM docs WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
"""


def _with_quotes(messages: DataFrame) -> DataFrame:
    """The table's messages quote nobody: every third one, by its place, is given a quote of the first line said two turns before it."""
    said = messages.where("conv_id is not null").groupBy("conv_id", (F.col("turn") + 2).alias("turn")).agg(F.min("text").alias("before"))
    quoted = (F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(3)) == 0) & F.col("before").isNotNull()
    text = F.when(quoted, F.concat(F.lit("> "), F.substring_index("before", "\n", 1), F.lit("\n"), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    return messages.join(said, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", text.alias("text"))


def op6_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quoting.quotation_links(_with_quotes(_table(spark, sf_dir, "conversations")))


_MARKS = r"^[\x20\x09]*>[\x20\x09>]*"
_OP6_SQL = rf"""
WITH RECURSIVE before AS (SELECT conv_id, turn + 2 AS turn, min(text) AS before FROM conversations GROUP BY 1, 2),
quoting AS (SELECT c.conv_id, c.turn, c.role, CASE WHEN (c.conv_id * 7 + c.turn) % 3 = 0 AND b.before IS NOT NULL
    THEN '> ' || split_part(b.before, chr(10), 1) || chr(10) || coalesce(c.text, '') ELSE c.text END AS text
    FROM conversations c LEFT JOIN before b ON c.conv_id = b.conv_id AND c.turn = b.turn),
one AS (SELECT conv_id, turn, min({{'role': role, 'text': coalesce(text, '')}}) AS said FROM quoting
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
lines AS (SELECT conv_id, turn, unnest(string_split(said.text, chr(10))) AS line FROM one),
marked AS (SELECT DISTINCT conv_id, turn, length(regexp_replace(regexp_extract(line, '{_MARKS}'), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(line, '{_MARKS}', '')), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm FROM lines),
own AS (SELECT conv_id, turn, said.role AS role, regexp_replace(array_to_string(list_filter(string_split(said.text, chr(10)),
    lambda x: NOT regexp_matches(x, '{_MARKS}')), chr(10)), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS text FROM one),
named AS (SELECT q.conv_id, q.turn AS by_turn, q.level, q.norm, max(o.turn) AS turn FROM marked q
    JOIN marked o ON q.conv_id = o.conv_id AND q.norm = o.norm AND o.turn < q.turn
    WHERE q.level > 0 AND o.level = 0 AND q.norm <> '' GROUP BY ALL),
votes AS (SELECT conv_id, by_turn, level, turn, count(*) AS n FROM named GROUP BY ALL),
best AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, by_turn ORDER BY level, n DESC, turn DESC) = 1),
replies AS (SELECT o.*, coalesce(b.turn, lag(o.turn) OVER (PARTITION BY o.conv_id ORDER BY o.turn)) AS parent, coalesce(b.n, 0)::BIGINT AS quoted
    FROM own o LEFT JOIN best b ON o.conv_id = b.conv_id AND o.turn = b.by_turn),
paths AS (SELECT conv_id, turn, [turn] AS path FROM replies WHERE parent IS NULL
    UNION ALL SELECT r.conv_id, r.turn, list_append(p.path, r.turn) FROM paths p JOIN replies r ON r.conv_id = p.conv_id AND r.parent = p.turn)
SELECT r.conv_id, r.turn, r.role, r.parent, len(p.path) - 1 AS depth, row_number() OVER (PARTITION BY r.conv_id ORDER BY p.path) - 1 AS place, r.quoted, r.text
FROM replies r JOIN paths p ON r.conv_id = p.conv_id AND r.turn = p.turn
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "rule")


#: The window of fetch dates and entry dates that the query's captures and list are given, in days from 2024-01-01.
_DAYS = 360


def _captures(pages: DataFrame) -> DataFrame:
    """Pages have no fetch time: one follows from the id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.pmod(F.col("page_id") * 37, F.lit(_DAYS))).cast("int")).cast("timestamp").alias("fetched_at"))


def _entries(pages: DataFrame) -> DataFrame:
    """A dated list over all hosts: each is blocked on one day, and lifted or allowed on a later one, by its length."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("pattern")).where("pattern <> ''").distinct()
    n = F.length("pattern")
    first = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(n * 53, F.lit(_DAYS)).cast("int"))
    log = F.array(F.struct(F.lit("block").alias("action"), first.alias("entry_date")), F.struct(F.when(n % 2 == 0, "lift").otherwise("allow").alias("action"), F.date_add(first, 60).alias("entry_date")))
    return hosts.where(n % 3 > 0).select("pattern", F.explode(log).alias("e")).select("pattern", "e.*")


def op9_url_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    judged = url_filter.filter_urls(_captures(pages), _entries(pages))
    return judged.select("page_id", "url", "kept", "reason", "pattern", F.date_format("since", "yyyy-MM-dd").alias("since"))


_HOST = r"lower(regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''))"
_OP9_SQL = rf"""
WITH captures AS (SELECT page_id, url, coalesce({_HOST}, '') AS host, DATE '2024-01-01' + (page_id * 37 % {_DAYS})::INTEGER AS fetched FROM pages),
hosts AS (SELECT DISTINCT host AS pattern, DATE '2024-01-01' + (length(host) * 53 % {_DAYS})::INTEGER AS day FROM captures WHERE host <> '' AND length(host) % 3 > 0),
periods AS (SELECT pattern, 'block' AS action, day AS since, day + 60 AS until FROM hosts
    UNION ALL SELECT pattern, 'allow', day + 60, NULL FROM hosts WHERE length(pattern) % 2 = 1),
hits AS (SELECT c.*, p.pattern, p.action, p.since FROM captures c LEFT JOIN periods p
    ON (c.host = p.pattern OR ends_with(c.host, '.' || p.pattern)) AND c.fetched >= p.since AND (p.until IS NULL OR c.fetched < p.until)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(p.pattern) - length(replace(p.pattern, '.', '')) DESC NULLS LAST, p.action DESC) = 1)
SELECT page_id, url, action IS DISTINCT FROM 'block' AS kept,
    CASE WHEN host = '' THEN 'no address' WHEN fetched IS NULL THEN 'no date' WHEN action IS NULL THEN 'unlisted' WHEN action = 'block' THEN 'blocked' ELSE 'allowed' END AS reason,
    pattern, strftime(since, '%Y-%m-%d') AS since FROM hits
"""


def op10_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


_OPERATORS = (
    op1_feistel_pseudonyms, op2_mix_sources, op3_ngram_jaccard, op4_language_fusion, op5_exact_dedup,
    op6_quotation_links, op7_line_dedup, op8_decision_list, op9_url_asof, op10_best_fit_pack,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": MIX_SQL.format(docs="documents") + "SELECT doc_id, size, source_size, target, copies * size AS taken FROM drawn",
        "op5_exact_dedup": _OP5_SQL,
        "op6_quotation_links": _OP6_SQL,
        "op9_url_asof": _OP9_SQL,
    }
