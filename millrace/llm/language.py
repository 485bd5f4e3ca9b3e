"""Language identification of pages by Bayesian evidence fusion.

The text's likelihood comes from character trigrams under a smoothed multinomial model per language, fitted
on labelled documents. It is fused with three more pieces of evidence, whose probabilities are grouped
aggregates over all pages: how pages of a language declare themselves in their markup, in which address
suffix they stand, and the languages of their host, where a host's prior is smoothed by its domain's, that
by the corpus's, and a page's own share is taken out of all of them.

The model has ``BUCKETS`` rows and one column per language with labels; ``max_languages`` bounds what is
broadcast, 256 KB a language, and ``fit`` raises when labels name more languages, so that none is lost. At
most ``MAX_PER_LANGUAGE`` labelled documents per language are fitted, the first by a hash of the id; all
else covers all pages. Defined results: a page without text is judged by the other evidence; null or missing
markup, suffix and host are values of their own; without labelled documents there is no language and lang is
null; rows that repeat are judged each on their own; an empty table gives an empty result; only the id,
address and markup columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import scratch
from .text import slices
from .url_filter import host_of

BUCKETS, MAX_PER_LANGUAGE, MAX_LANGUAGES = 1 << 15, 1000, 200
#: A text counts as at most so many independent trigrams; neighbouring ones repeat each other.
WORTH, SMOOTH, HOST_WEIGHT, DOMAIN_WEIGHT = 40, 0.5, 4.0, 8.0
#: What is open at the end hides all up to it, and a tag holds no other, so that no text is scanned again and again.
HIDDEN = r"(?is)<(script|style|noscript|template)\b.*?(?:</\1[^<>]*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>|&#?\w+;"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram of bytes, row of each), letters lower-cased and all else one space."""
    texts = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), r"[^\pL]+", " ")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(ends))
    code = data[:-2] | data[1:-1] << 8 | data[2:] << 16
    whole = rows[:-2] == rows[2:]
    return (code[whole] * np.uint32(0x9E3779B1) >> np.uint32(32 - 15)).astype(np.int64), rows[:-2][whole]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            buckets, rows = grams_of(part.column("text"))
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in set(langs):
                here = buckets[langs[rows] == lang] if len(rows) else buckets
                counts[lang] = counts.get(lang, np.zeros(BUCKETS, np.int64)) + np.bincount(here, minlength=BUCKETS)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", per_language: int = MAX_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """The model from labelled documents; languages in order of their names. More than max_languages of them raise ValueError."""
    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    # a hash threshold that leaves about twice the bound per language, so that no language is sorted whole
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"labels name more than {max_languages} languages; max_languages bounds the table that is broadcast")
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)))
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30))
    limits = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1 << 30, int((1 << 30) * (2 * per_language + 100) / n))))])
    near = rows.withColumn("place", place).where(F.col("place") < limits[F.col("lang")])
    chosen = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))).where(F.col("k") <= per_language)
    counted = chosen.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    table = np.zeros((BUCKETS, len(languages)))
    if len(counted):
        table[counted["bucket"].to_numpy(), [languages.index(x) for x in counted["lang"]]] = counted["n"].to_numpy()
    log_p = np.log(table + SMOOTH) - np.log(table.sum(axis=0) + SMOOTH * BUCKETS)
    return Model(languages, log_p)


def text_evidence(texts: pa.Array, model: Model) -> np.ndarray:
    """Log-likelihoods, a row per text, shrunk to WORTH trigrams, highest 0."""
    buckets, rows = grams_of(texts)
    n = np.bincount(rows, minlength=len(texts))
    out = np.stack([np.bincount(rows, model.log_p[buckets, k], minlength=len(texts)) for k in range(len(model.languages))], axis=1).astype(float)  # counts of nothing come as integers
    out *= (np.minimum(n, WORTH) / np.maximum(n, 1))[:, None]
    return out - out.max(axis=1, keepdims=True)


def visible_text(html: Column) -> Column:
    return F.regexp_replace(html, HIDDEN, " ")


def declared_language(html: Column) -> Column:
    """The first lang attribute of the html element, its main part in lower case; null if there is none."""
    said = F.lower(F.regexp_extract(html, r"(?is)<html\b[^<>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", 1))
    return F.when(said != "", said)


def _smoothed(languages: range, sums: str, own: str, weight: float, parent: list[Column]) -> list[Column]:
    """Share of each language in a group without the page itself, pulled to the parent's shares by weight pages."""
    rest = [F.greatest(F.col(f"{sums}{k}") - F.col(f"{own}{k}"), F.lit(0.0)) for k in languages]
    total = sum(rest[1:], rest[0])
    return [(rest[k] + weight * parent[k]) / (total + weight) for k in languages]


def identify(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, suffix, host; one row per row of pages."""
    host, html = host_of(F.col(f"`{url_col}`")), F.col(f"`{html_col}`")
    parsed = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"), F.coalesce(declared_language(html), F.lit("")).alias("declared"), F.coalesce(visible_text(html), F.lit("")).alias("text"),
    )
    known = ("page_id", "host", "domain", "suffix", "declared")
    if not model.languages:
        none = F.lit(None).cast("string")
        return parsed.select("page_id", none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), "declared", "suffix", "host")
    ks, sent = range(len(model.languages)), pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                logs = text_evidence(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in known), *(pa.array(logs[:, k]) for k in ks)], [*known, *(f"l{k}" for k in ks)])

    scored = scratch(parsed.mapInArrow(run, "page_id long, host string, domain string, suffix string, declared string, " + ", ".join(f"l{k} double" for k in ks)), "scored")
    exps = [F.exp(f"l{k}") for k in ks]
    soft = scored.select("*", *[(e / sum(exps[1:], exps[0])).alias(f"p{k}") for k, e in zip(ks, exps, strict=True)])

    def sums(by: str, name: str) -> DataFrame:
        return soft.groupBy(F.col(by).alias(f"_{name}")).agg(*[F.sum(f"p{k}").alias(f"{name}{k}") for k in ks])

    tables = {name: scratch(sums(by, name), name) for by, name in (("host", "h"), ("domain", "d"), ("suffix", "s"), ("declared", "m"))}
    whole = tables["m"].agg(*[F.sum(f"m{k}").alias(f"a{k}") for k in ks], F.count("*").alias("values"))
    kinds = tables["s"].agg(F.count("*").alias("kinds"))
    joined = soft
    for by, name in (("host", "h"), ("domain", "d"), ("suffix", "s"), ("declared", "m")):
        joined = joined.join(tables[name], F.col(by) == F.col(f"_{name}")).drop(f"_{name}")
    joined = joined.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(kinds))  # one row each
    flat = [F.lit(1.0 / len(ks))] * len(ks)
    corpus = _smoothed(ks, "a", "p", 1.0, flat)
    prior = _smoothed(ks, "h", "p", HOST_WEIGHT, _smoothed(ks, "d", "p", DOMAIN_WEIGHT, corpus))

    def given(sums: str, values: Column, k: int) -> Column:
        """Probability of this page's value among pages of language k."""
        mine, all_ = (F.greatest(F.col(f"{x}{k}") - F.col(f"p{k}"), F.lit(0.0)) for x in (sums, "a"))
        return (mine + 0.5) / (all_ + 0.5 * values)

    logs = [F.col(f"l{k}") + F.log(prior[k]) + F.log(given("m", F.col("values"), k)) + F.log(given("s", F.col("kinds"), k)) for k in ks]
    fused = joined.select("*", *[x.alias(f"f{k}") for k, x in zip(ks, logs, strict=True)])
    top = (lambda cols: F.greatest(*cols) if len(cols) > 1 else cols[0])([F.col(f"f{k}") for k in ks])
    best = lambda name: F.array_max(F.array(*[F.struct(F.col(f"{name}{k}").alias("v"), F.lit(-k).alias("k")) for k in ks]))["k"]
    names = F.array(*[F.lit(x) for x in model.languages])
    parts = [F.exp(F.col(f"f{k}") - top) for k in ks]
    return fused.select("page_id", F.element_at(names, 1 - best("f")).alias("lang"), (1 / sum(parts[1:], parts[0])).alias("confidence"), F.element_at(names, 1 - best("l")).alias("text_lang"), "declared", "suffix", "host")
