"""Large groups against brute force: near the threshold, below it, around a hot line, with groups inside groups."""

import random

import pytest

from millrace.llm import jaccard
from test_jaccard_links import _brute
from test_training_data import _docs


def _edited(rng, words, k):
    words = list(words)
    for at in rng.sample(range(len(words)), k):
        words[at] = f"e{rng.randrange(10**9)}"
    return words


def _below(rng):
    """Copies of one text of which no two link: each is on its own side of it."""
    base = [f"b{k}" for k in range(120)]
    return [" ".join(_edited(rng, base, 2)) for _ in range(120)]


def _around(rng):
    """Copies at mixed distances; only some link, and only by way of others."""
    base = [f"c{k}" for k in range(400)]
    return [" ".join(_edited(rng, base, rng.choice([1, 2, 3, 4, 6, 9]))) for _ in range(150)]


def _nested(rng):
    """Groups inside a group: several share a changed stretch."""
    out, base = [], [f"d{k}" for k in range(300)]
    for g in range(6):
        inner = base[:40] + [f"g{g}x{k}" for k in range(rng.choice([3, 6, 9]))] + base[50:]
        out += [" ".join(_edited(rng, inner, rng.choice([0, 1, 2, 3]))) for _ in range(20)]
    return out


def _hot_line(rng):
    """Many texts that share a line and little else."""
    line = " ".join(f"h{k}" for k in range(60))
    return [line + "\n" + " ".join(f"o{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 40]))) for _ in range(300)]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_large_groups(spark, n, percent):
    rng = random.Random(21)
    texts = _below(rng) + _around(rng) + _nested(rng) + _hot_line(rng)
    texts += texts[::17]
    rng.shuffle(texts)
    docs = _docs(spark, texts)
    sets, low, links = _brute(texts, n, percent)
    got = [tuple(r) for r in jaccard.jaccard_links(docs, n, percent).collect()]
    assert len(links) > 500 and len(got) == len(set(got)) and set(got) == links
    count = dict.fromkeys(range(len(texts)), 0)
    for pair in links:
        for k in pair:
            count[k] += 1
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.jaccard_answers(docs, n, percent).collect()}
    components = [low[frozenset(s)] if s else k for k, s in enumerate(sets)]
    for b, a in sorted(links):
        x, y = components[a], components[b]
        components = [min(x, y) if v in (x, y) else v for v in components] if x != y else components
    assert rows == {k: (len(s), components[k], count[low[frozenset(s)]]) for k, s in enumerate(sets)}


def test_ids_that_repeat_or_lack(spark):
    text = [f"w{k}" for k in range(80)]
    rows = [(5, " ".join(text)), (5, " ".join(text)), (5, "quite another text of six"), (7, " ".join(text[:79])), (9, "quite another text of six"), (None, " ".join(text)), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.jaccard_answers(docs, 3, 90).collect()), key=repr)
    want = [(5, 78, 5, 1), (5, 78, 5, 1), (5, 3, 5, 1), (7, 77, 5, 1), (9, 3, 5, 1), (None, 78, None, None), (11, 0, 11, 0)]
    assert got == sorted(want, key=repr)
    assert jaccard.jaccard_answers(docs.limit(0), 3, 90).count() == 0


def test_sketches_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (1, 50, 400, 5000, 60000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 300), dtype=np.uint64)]))
        x, y = jaccard._odd_bits(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert jaccard._odd_between(x, y) == jaccard._odd_between(y, x) and jaccard._odd_between(x, y)[0] <= len(np.setxor1d(a, b))
        assert jaccard._odd_between(x, x)[0] == 0


def test_odd_names_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2), (2, "a b c d e f", 3, 4), (3, "x", 5, 6)], "doc_id long, text string, _stays int, row_no int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d e f", 1, 2), (3, "x", 5, 6)]
