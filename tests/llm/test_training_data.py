"""The ten operators against brute force, with nulls, empty and repeated rows, and clashing names."""

import hashlib
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, jaccard, language, line_dedup, mixing, packing, pseudonyms, quality, quoting, url_filter
from millrace.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{k}" for k in range(300)]


def _docs(spark, texts, sources=("a", "b", None)):
    return spark.createDataFrame([(k, t, "en", sources[k % len(sources)], len(t or "")) for k, t in enumerate(texts)], DOCS)


def _shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def _components(texts, n, percent):
    sets, low = [_shingles(t, n) for t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = low[a], low[b]
            low = [min(x, y) if v in (x, y) else v for v in low]
    return sets, low


def _near_copies(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "One", "one", "two words", "Two  words"]
    shared = " ".join(rng.choices(VOCABULARY, k=40))
    for _ in range(25):
        base = rng.choices(VOCABULARY, k=rng.choice([5, 30, 90, 200]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            texts.append(" ".join(words) + (" " + shared if rng.random() < 0.3 else ""))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 5, 80), (3, 3, 90)])
def test_jaccard_components(spark, seed, n, percent):
    texts = _near_copies(seed)
    sets, low = _components(texts, n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(_docs(spark, texts), n, percent).collect()}
    assert got == {k: (len(s), c) for k, (s, c) in enumerate(zip(sets, low, strict=True))}


def test_jaccard_keeps_one_of_each(spark):
    texts = _near_copies(4)
    kept = {r["doc_id"] for r in jaccard.one_of_each(_docs(spark, texts)).collect()}
    assert kept == set(_components(texts, 5, 80)[1])
    assert jaccard.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_exact_dedup(spark):
    texts = [None, "", "a  b", "a\tb", "A b", "a b", " a b", "long " * 30000, "long " * 30000]
    rows = {r["doc_id"]: r for r in exact_dedup.exact_dedup(_docs(spark, texts)).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for k, t in enumerate(norm):
        same = [j for j, u in enumerate(norm) if u == t]
        assert (rows[k]["keep_id"], rows[k]["group_size"], rows[k]["kept"], rows[k]["text_sha256"]) == (same[0], len(same), same[0] == k, hashlib.sha256(t.encode()).hexdigest())
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_mixing_near_targets(spark):
    rng = random.Random(5)
    texts = [" ".join(["w"] * rng.randrange(1, 60)) for _ in range(900)] + [None, ""]
    rows = mixing.mix_sources(_docs(spark, texts)).collect()
    assert len(rows) == len(texts)
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3 * 60
        assert own[0]["target"] <= 3 * own[0]["source_size"] + 1e-6
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    drawn = {r["doc_id"]: r["n"] for r in mixing.mixed_documents(_docs(spark, texts)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert drawn == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}


def test_line_dedup_by_edit_distance(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choices("abcd e", k=rng.choice([1, 3, 6, 12]))) for _ in range(12)]
    texts = [None, "", "  \n"]
    for _ in range(25):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            s = list(rng.choice(pool))
            if rng.random() < 0.6:
                s[rng.randrange(len(s))] = rng.choice(["", "x", "aa", "b"])
            lines.append("".join(s))
        texts.append("\n".join(lines))

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1:
            return False
        k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
        return a[k + (len(a) == len(b)) :] == b[k + 1 :]

    earlier, want = [], []
    for t in texts:
        out = []
        for line in (t or "").split("\n"):
            if not WORD.search(line):
                out.append(line)
                continue
            if not any(near(line, e) for e in earlier):
                out.append(line)
            earlier.append(line)
        want.append(None if t is None else "\n".join(out))
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(_docs(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_quality_statistics(spark):
    rng = random.Random(7)
    texts = [None, "", "x " * 40, "a b\na b\n\nc #$", "é" * 5 + " |"] + [" ".join(rng.choices(VOCABULARY[:12], k=rng.choice([5, 30, 120]))) for _ in range(30)]
    rows = {r["doc_id"]: r for r in quality.quality(_docs(spark, texts)).collect()}
    for k, t in enumerate(texts):
        t = t or ""
        words = WORD.findall(t)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert tuple(rows[k][c] for c in quality.BASE) == want
        assert rows[k]["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))


def test_decision_list_finds_a_planted_rule(spark):
    rng = random.Random(8)
    bad = [k % 3 == 0 for k in range(300)]
    texts = [" ".join(rng.choices(VOCABULARY, k=60)) + (" ###" * 12 if b else "") for b in bad]
    labels = spark.createDataFrame([(k, 0 if b else 1) for k, b in enumerate(bad)], "doc_id long, quality int")
    rows = quality.quality(_docs(spark, texts), labels).collect()
    assert sum(r["kept"] == (not bad[r["doc_id"]]) for r in rows) >= 297
    assert all(r["kept"] for r in quality.quality(_docs(spark, texts), labels.limit(0)).collect())


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    texts = [None, "", "é ü\n\n  x"] + [" ".join(rng.choices(VOCABULARY, k=rng.choice([3, 100, 700, 3000]))) for _ in range(25)]
    placed = packing.pack_documents(_docs(spark, texts), tokenizer_path(), with_ids=True).cache()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = sorted(placed.collect(), key=lambda r: (r["doc_id"], r["piece"]))
    ids = {}
    for r in rows:
        assert r["start"] == len(ids.setdefault(r["doc_id"], [])) and len(r["ids"]) == r["length"] <= 2048
        ids[r["doc_id"]] += r["ids"]
    assert ids == {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    # no two pieces of more than half a sequence share one
    least = max(-(-sum(ends.values()) // 2048), sum(r["length"] > 1024 for r in rows))
    assert max(ends.values()) <= 2048 and len(ends) <= least + 1


def test_pseudonyms_link_and_keep_their_format(spark):
    texts = ["card 4111 1111 1111 1111 on 2024-02-29", "4111111111111111 mail ann.b@example.org", "ip 10.0.0.1 and 999.1.1.1", "4111 1111 1111 1112", None, ""]
    rows = {r["doc_id"]: r for r in pseudonyms.pseudonymise(_docs(spark, texts), "key").collect()}
    assert [rows[k]["n_pseudonyms"] for k in range(6)] == [2, 2, 1, 0, 0, 0]
    a = re.search(r"(?:\d{4} ){3}\d{4}", rows[0]["text"])[0].replace(" ", "")
    digits = [int(c) for c in a[::-1]]
    assert a == rows[1]["text"][:16] != "4111111111111111" and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"mail [a-z]{3}\.[a-z]@example\.org$", rows[1]["text"]) and "999.1.1.1" in rows[2]["text"] and rows[4]["text"] is None


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    pages = docs.where("doc_id % 2 = 1 and n_chars > 200").select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"), "lang")
    got = language.identify(pages, model).join(pages.select("page_id", F.col("lang").alias("truth")), "page_id")
    assert got.where("lang = truth").count() >= 0.97 * got.count()


def test_quotation_links(spark):
    chat = [
        (1, 0, "user", "Hello there\nsecond line"), (1, 1, "assistant", "> hello  THERE\nHi"), (1, 2, "user", "Other"), (1, 3, "assistant", ">> hello there\n> hi\nDeep"),
        (1, 4, "user", "> nobody said\nAlone"), (2, 0, "user", None), (2, 1, "user", "> hello there"), (None, 0, "user", "x"),
    ]
    linked = quoting.quotation_links(spark.createDataFrame(chat, "conv_id long, turn long, role string, text string"))
    got = {(r["conv_id"], r["turn"]): (r["parent"], r["depth"], r["place"], r["text"]) for r in linked.collect()}
    assert got == {(1, 0): (None, 0, 0, "Hello there\nsecond line"), (1, 1): (0, 1, 1, "Hi"), (1, 2): (1, 2, 2, "Other"), (1, 3): (1, 2, 3, "Deep"), (1, 4): (3, 3, 4, "Alone"), (2, 0): (None, 0, 0, ""), (2, 1): (0, 1, 1, "")}
    chats = {(r["conv_id"], r["leaf"]): [m["content"] for m in r["messages"]] for r in quoting.formatted(linked).collect()}
    assert chats[1, 2] == ["Hello there\nsecond line", "Hi", "Other"] and len(chats) == 3


def test_url_filter_asof(spark):
    entries = spark.createDataFrame([("example.com", "block", "2024-02-01"), ("example.com", "lift", "2024-03-01"), ("example.com/ok", "allow", "2024-01-01")], "pattern string, action string, entry_date string").withColumn("entry_date", F.to_date("entry_date"))
    rows = [(1, "http://a.example.com/x", "2024-01-31"), (2, "http://a.example.com/x", "2024-02-01"), (3, "http://example.com/ok/p", "2024-02-02"), (4, "http://example.com", "2024-03-01"), (5, None, "2024-02-02"), (6, "http://example.com", None), (2, "http://a.example.com/x", "2024-02-01")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    got = sorted((r["page_id"], r["reason"]) for r in url_filter.filter_urls(captures, entries).collect())
    assert got == [(1, "unlisted"), (2, "blocked"), (2, "blocked"), (3, "allowed"), (4, "unlisted"), (5, "no address"), (6, "no date")]
