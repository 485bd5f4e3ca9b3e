"""Texts that are very long, of one character, of separators or of an operator's own marks; nulls, repeated rows, clashing names, empty tables."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, language, mixing, packing, pseudonyms, quality, quoting, scratch, url_filter
from millrace.llm.queries import tokenizer_path

N = 1_000_000
LONG = {"one": "a" * N, "space": " " * N, "digits": "7" * N, "marks": ">" * N, "labels": "x@a" + ".a" * (N // 2), "tags": "<script" * (N // 7), "lines": "\n" * N, "dots": "1." * (N // 2), "open": "<" * N, "amp": "&a" * (N // 2), "inner": "x" + " " * N + "x"}
SCHEMA = "doc_id int, text string, lang string, source string, found int, c0 int, `a.b` int, copies int, text_sha256 string"


def _odd(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", 1, 2, 3, 4, "x") for k, t in enumerate(texts)], SCHEMA)


def test_long_texts_everywhere(spark):
    texts = [*LONG.values(), None, ""]
    docs, n = _odd(spark, texts), len(texts)
    ends = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(docs, "k").select("doc_id", F.substring("text", -10, 10).alias("text")).collect()}
    assert all(ends[k] == (t and t[-10:]) for k, t in enumerate(texts) if t is None or t)
    assert exact_dedup.exact_dedup(docs).count() == n and exact_dedup.without_copies(docs).count() == n - 2  # null is empty, and runs of white space are one
    assert quality.quality(docs).count() == n and quality.good_documents(docs, []).columns == docs.columns
    chat = [row for k, t in enumerate(LONG.values()) for row in ((k, 0, "user", "hello"), (k, 1, "user", t), (k, 2, None, None))]
    got = {(r["conv_id"], r["turn"]): r for r in quoting.quotation_links(spark.createDataFrame(chat, "conv_id long, turn int, role string, text string")).collect()}
    for k, (kind, t) in enumerate(LONG.items()):
        assert got[k, 1]["text"] == ("" if kind == "marks" else t.strip(" \t\n\x0b\x0c\r")) and [got[k, j]["depth"] for j in range(3)] == [0, 1, 2]
    model = language.fit(spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")], "doc_id long, text string, lang string"))
    pages = [(k, "http://h.org/a", t) for k, t in enumerate(texts)] + [(100 + k, t, None) for k, t in enumerate(texts)]
    assert language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).count() == 2 * n
    entries = spark.createDataFrame([("h.org", "block", datetime.date(2024, 1, 1))], "pattern string, action string, entry_date date")
    urls = [(1, "http://h.org/" + "a/" * 100_000), (2, "http://" + ".".join("a" * 100_000) + "/" + "b/" * 5000), *((3 + k, t) for k, t in enumerate(texts))]
    captures = spark.createDataFrame(urls, "page_id long, url string").withColumn("fetched_at", F.lit("2024-02-01").cast("timestamp"))
    assert {r["page_id"] for r in url_filter.filter_urls(captures, entries).collect() if not r["kept"]} == {1}
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    assert max(r["length"] for r in rows) <= 2048 and {r["doc_id"] for r in rows} == set(range(n))


def test_ids_of_long_runs():
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = [LONG[k] for k in ("space", "digits", "inner", "marks")]
    ids, sizes = packing.Encoder(tokenizer_path())(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_names_rows_and_empty_tables(spark):
    docs = _odd(spark, ["same text here", "same  text here", None, "", "other words"])
    docs = docs.unionByName(docs.limit(1))
    names = docs.columns
    assert exact_dedup.without_copies(docs).columns == names and sorted(r["doc_id"] for r in exact_dedup.without_copies(docs).collect()) == [0, 2, 4]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == names and mixed.where("copies <> 4 or c0 <> 2").count() == 0
    assert pseudonyms.pseudonymise(docs, "k").columns == [*names, "n_pseudonyms"]
    nothing = docs.limit(0)
    for table in (exact_dedup.exact_dedup(nothing), exact_dedup.without_copies(nothing), mixing.mixed_documents(nothing), mixing.mix_sources(nothing), pseudonyms.pseudonymise(nothing, "k"), quality.good_documents(nothing, []), packing.pack_documents(nothing, tokenizer_path())):
        assert table.count() == 0
    ids = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (3, "a b"), (None, None)], "doc_id int, text string")
    got = sorted((tuple(r)[:4] for r in exact_dedup.exact_dedup(ids).collect()), key=repr)
    assert got == sorted([(None, 3, 4, False), (None, 3, 4, False), (3, 3, 4, True), (3, 3, 4, False), (None, None, 1, True)], key=repr)


def test_capped_sources_share_the_rest(spark):
    texts = {"a": 40, "b": 400, "c": 30, "d": 900}
    docs = spark.createDataFrame([(k * 1000 + ord(s), "w " * 10, s) for s, n in texts.items() for k in range(n)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs).collect()
    total = 10 * sum(texts.values())
    weights, size, target = dict(zip("abcd", (1, 2, 3, 1), strict=True)), {s: 10 * n for s, n in texts.items()}, {}
    while True:  # plain water filling
        open_ = [s for s in weights if s not in target]
        left, share = total - sum(target.values()), sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / share > 3 * size[s]]
        if not over:
            target |= {s: left * weights[s] / share for s in open_}
            break
        target |= {s: 3.0 * size[s] for s in over}
    assert any(target[s] == 3 * size[s] for s in target)
    for s in texts:
        own = [r for r in rows if r["source"] == s]
        assert abs(own[0]["target"] - target[s]) < 1e-6 and abs(sum(r["taken"] for r in own) - target[s]) <= 30


def test_feistel_is_a_permutation(spark):
    n = 60
    one = spark.range(n * n).select(F.floor(F.col("id") / n).alias("l"), (F.col("id") % n).alias("r"))
    for a, b in ((60, 60),):
        images = one.select(pseudonyms.feistel_pair("k", "t", F.col("l"), F.col("r"), F.lit(a), F.lit(b)).alias("p")).select("p.*")
        assert images.distinct().count() == n * n and images.where("l < 0 or r < 0 or l >= 60 or r >= 60").count() == 0
    formats = {"ssn": ["%03d-%02d-%04d" % (1 + k % 600, 1 + k % 99, 1 + k * 37 % 9999) for k in range(300)], "phone": ["+44 20 %04d %04d" % (k * 31 % 10000, k) for k in range(300)], "hex": ["%032x" % (k * 0x1234567890ABCDEF1234567) for k in range(300)], "date": [str(datetime.date(1990, 1, 1) + datetime.timedelta(37 * k)) for k in range(300)], "ip": ["10.%d.%d.7" % (k % 250, k // 2) for k in range(300)]}
    shapes = {"ssn": r"\d{3}-\d{2}-\d{4}", "phone": r"\+44 \d\d \d{4} \d{4}", "hex": "[0-9a-f]{32}", "date": r"\d{4}-\d\d-\d\d", "ip": r"(?:\d{1,3}\.){3}\d{1,3}"}
    for kind, values in formats.items():
        rows = pseudonyms.pseudonymise(spark.createDataFrame([(v,) for v in values], "text string"), "k").collect()
        images = [r["text"] for r in rows]
        assert all(r["n_pseudonyms"] == 1 for r in rows), kind
        assert all(re.fullmatch(shapes[kind], x) for x in images) and len(set(images)) == len(set(values)) and images != values
        if kind == "date":
            assert all(datetime.date.fromisoformat(x) for x in images)
    other = pseudonyms.pseudonymise(spark.createDataFrame([("10.1.2.3",)], "text string"), "another").first()[0]
    assert other != pseudonyms.pseudonymise(spark.createDataFrame([("10.1.2.3",)], "text string"), "k").first()[0]


def test_long_chats_and_hot_lines(spark):
    n = 9000
    chat = [(1, t, "user", "hi") for t in range(n)] + [(2, t, "user", "> hi\nok" if t else "hi") for t in range(300)] + [(2, 5, "user", "zz")]
    linked = quoting.quotation_links(spark.createDataFrame(chat, "conv_id long, turn long, role string, text string"))
    rows = {(r["conv_id"], r["turn"]): r for r in linked.collect()}
    assert all((rows[1, t]["depth"], rows[1, t]["place"], rows[1, t]["parent"]) == (t, t, t - 1 if t else None) for t in range(n))
    assert all((rows[2, t]["depth"], rows[2, t]["place"], rows[2, t]["parent"], rows[2, t]["quoted"]) == (1, t, 0, 1) for t in range(1, 300) if t != 5)
    assert len(rows) == n + 300 and quoting.quotation_links(linked.select("conv_id", "turn", "role", "text").limit(0)).count() == 0


def test_replies_against_a_plain_tree(spark):
    rng = random.Random(41)
    chat, tree = [], {}
    for conv in range(12):
        said = []
        for turn in range(rng.randrange(1, 25)):
            text = f"line {conv} {turn}"
            parent = turn - 1 if turn else None
            if turn and rng.random() < 0.7:
                parent = rng.randrange(turn)
                text = f"> line {conv} {parent}\n{text}"
            said.append(turn)
            chat.append((conv, turn * 10_000, "user", text))
            tree[conv, turn] = parent
    got = {(r["conv_id"], r["turn"] // 10_000): r for r in quoting.quotation_links(spark.createDataFrame(chat, "conv_id long, turn long, role string, text string")).collect()}

    def walk(conv, turn, depth, out):
        out.append((turn, depth))
        for t in sorted(t for (c, t), p in tree.items() if c == conv and p == turn and t != turn):
            walk(conv, t, depth + 1, out)

    for conv in range(12):
        out = []
        walk(conv, 0, 0, out)
        for place, (turn, depth) in enumerate(out):
            assert (got[conv, turn]["place"], got[conv, turn]["depth"]) == (place, depth)


def test_evidence_beside_the_text(spark):
    words = {"en": "the cat and the dog with this house", "fr": "le chat et le chien avec cette maison"}
    model = language.fit(spark.createDataFrame([(k, words[lang] + f" {k}", lang) for k, lang in enumerate(["en", "fr"] * 20)], "doc_id long, text string, lang string"))
    page = lambda k, host, lang, text: (k, f"http://{host}/{k}", f"<html lang={lang}><p>{text}</p>" if lang else f"<p>{text}</p>")
    pages = [page(k, "a.example.fr", "fr", words["fr"]) for k in range(20)] + [page(100 + k, "b.example.uk", "en", words["en"]) for k in range(20)]
    pages += [page(200, "a.example.fr", None, ""), page(201, "b.example.uk", None, ""), page(202, "c.other.org", "fr", ""), page(203, "d.other.fr", None, "")]
    got = {r["page_id"]: r["lang"] for r in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert [got[k] for k in (200, 201, 202, 203)] == ["fr", "en", "fr", "fr"] and got[0] == "fr" and got[100] == "en"


def test_lists_with_ties_and_odd_rows(spark):
    day = lambda x: datetime.date.fromisoformat(x)
    entries = [("ex.org", "block", day("2024-01-01")), ("ex.org", "allow", day("2024-01-01")), ("ex.org/p/q", "allow", day("2024-01-05")), (None, "block", day("2024-01-01")), ("x.org", "nonsense", day("2024-01-01"))]
    list_ = spark.createDataFrame(entries, "pattern string, action string, entry_date date")
    rows = [(1, "http://A.ex.org./p/q/r", "2024-01-04", 0, 9), (1, "http://A.ex.org./p/q/r", "2024-01-04", 0, 9), (2, "http://ex.org:80/p/q/r?x", "2024-01-05", 0, 9), (3, "http://x.org", "2024-01-05", 0, 9), (None, "no address", "2024-01-05", 0, 9), (4, None, None, 0, 9)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at string, kept int, address int")
    out = url_filter.filter_urls(captures, list_)
    got = sorted(((r["page_id"], r["kept"], r["reason"], r["address"]) for r in out.collect()), key=repr)
    assert got == sorted([(1, False, "blocked", 9), (1, False, "blocked", 9), (2, True, "allowed", 9), (3, True, "unlisted", 9), (None, True, "no address", 9), (4, True, "no address", 9)], key=repr)
    assert all(r["reason"] in ("unlisted", "no address") for r in url_filter.filter_urls(captures, list_.limit(0)).collect())
    assert url_filter.filter_urls(captures.limit(0), list_).count() == 0


def test_labels_that_multiply_are_bounded(spark):
    docs = spark.createDataFrame([(1, "word " * 5 + f"{k} " + " ".join(f"u{k}x{j}" for j in range(30))) for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, k % 2) for k in range(50)], "doc_id long, quality int")
    seen = []
    plain = quality.learn
    try:
        quality.learn = lambda x, bad, fold: seen.append(len(bad)) or plain(x, bad, fold)
        quality.fit(docs, labels, max_labelled=40)
    finally:
        quality.learn = plain
    assert seen == [40]


def test_scratch_is_freed(spark):
    start = scratch.mark()
    a, b = (scratch.scratch(spark.range(3), name) for name in "ab")
    scratch.release(spark, start, spared=1)
    assert b.count() == 3 and scratch.mark() == start + 1
    with pytest.raises(Exception, match="exist|File"):
        a.count()
    scratch.release(spark, start)
