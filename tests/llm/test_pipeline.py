"""run() against plain versions of its five stages, on a small corpus."""

import random
import zlib

import numpy as np

import corpus_pipeline
from millrace.llm import mixing, quality
from millrace.llm.queries import tokenizer_path
from test_jaccard_links import _brute
from test_line_dedup_edges import _brute as _cleared
from test_training_data import VOCABULARY, WORD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus(rng):
    rows, footer = [], "All rights reserved, the usual words that stand below many texts and say nothing new"
    for k in range(90):
        words = rng.choices(VOCABULARY, k=rng.choice([8, 30, 60, 120]))
        lines = [" ".join(words[i : i + 12]) for i in range(0, len(words), 12)]
        if k % 4 == 0:
            lines.append(footer + "." * (k % 8 == 0))
        if k % 7 == 3:
            lines.append("### $$$ " * 12)
        rows.append(("\n".join(lines), "abc"[k % 3]))
    for k in range(0, 60, 5):  # copies as they are, and with all lines touched in two words
        rows.append(rows[k])
        again = rows[k + 1][0].split(" ")
        for at in range(0, len(again), 40):
            again[at] = again[at] + "x\n" if "\n" not in again[at] else again[at]
        rows.append((" ".join(again), "b"))
    return [(k, text, "en", source, len(text)) for k, (text, source) in enumerate(rows)]


def test_whole_run(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(51)
    rows = _corpus(rng)
    marks = [(k, int("###" not in text)) for k, text, *_ in rows[:60]]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, labels = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "labels"))

    # 1: the base rule by hand; the learned rules, which all find the planted symbols, by hand on the statistics
    rules = quality.fit(docs, labels)
    assert rules
    held, good = {r["doc_id"]: r for r in quality.features(quality.text_stats(docs)).collect()}, []
    for k, text, _, source, _ in rows:
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        fails = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        hit = any(all((held[k][t.feature] >= t.threshold) if t.above else (held[k][t.feature] <= t.threshold) for t in rule.tests) for rule in rules)
        if not fails and not hit:
            good.append((k, text, source))
    assert 20 < len(good) < len(rows) and not any("###" in t for _, t, _ in good)
    # 2: lines
    cleared = _cleared([(k, t) for k, t, _ in good])
    lined = [(k, cleared[k, t], source) for k, t, source in good if any(WORD.search(x) for x in cleared[k, t].split("\n"))]
    assert len(lined) < len(good) or any(cleared[k, t] != t for k, t, _ in good)
    # 3: near copies
    sets, _, links = _brute([t for _, t, _ in lined], 5, 80)
    part = list(range(len(lined)))
    same = [(b, a) for a in range(len(lined)) for b in range(a + 1, len(lined)) if sets[a] and sets[a] == sets[b]]
    for b, a in sorted({*links, *same}):
        x, y = part[a], part[b]
        part = [min(x, y) if v in (x, y) else v for v in part]
    single = [lined[k] for k in sorted(set(part))]
    # 4: systematic sampling, by one loop over each source in the operator's order
    frame = spark.createDataFrame(single, "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(frame).collect()}
    drawn = sorted(k for k, _, _ in single for _ in range(copies[k]))
    total, text_of = sum(len(WORD.findall(t)) for _, t, _ in single), {k: t for k, t, _ in single}
    sizes = {s: sum(len(WORD.findall(t)) for _, t, x in single if x == s) for s in "abc"}
    for weight, s in enumerate("abc", 1):
        taken = sum(copies[k] * len(WORD.findall(t)) for k, t, x in single if x == s)
        if all(total * w / 6 <= 3 * sizes[x] for w, x in enumerate("abc", 1)):
            assert abs(taken - total * weight / 6) <= 3 * 140
    # 5: packing gives back each drawn document's ids, gapless and never beyond a sequence
    tokenizer, out = Tokenizer.from_file(tokenizer_path()), corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out if r["piece"] == 0) == drawn
    for r in out:
        ids = (tokenizer.encode(text_of[r["doc_id"]], add_special_tokens=False).ids + [0])[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    ends = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(ends.values()) // 2048) + 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "source_mix", "best_fit_packing"]
    assert mixing.CAP == 3
