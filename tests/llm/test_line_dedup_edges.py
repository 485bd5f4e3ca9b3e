"""Long lines, wide characters, repeated rows, null ids, empty tables and clashing names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup
from test_training_data import DOCS, WORD


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _brute(rows):
    """What each of the rows (doc_id, text), with different ids or one text an id, is left with."""
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    earlier, out = [], {}
    for doc, text in order:
        left = []
        for line in text.split("\n"):
            if not WORD.search(line):
                left.append(line)
                continue
            if not any(_near(line, e) for e in earlier):
                left.append(line)
            earlier.append(line)
        out[doc, text] = "\n".join(left)
    return out


def _changed(rng, line, alphabet):
    s, at = list(line), rng.randrange(len(line))
    kind = rng.randrange(3)
    if kind == 0:
        s[at] = rng.choice(alphabet)
    elif kind == 1:
        del s[at]
    else:
        s.insert(at, rng.choice(alphabet))
    return "".join(s)


def test_lines_of_all_lengths(spark):
    rng = random.Random(31)
    alphabet = "abcd éß中🙂\t"
    pool = ["".join(rng.choices(alphabet, k=k)) for k in (1, 2, 3, 15, 16, 17, 18, 31, 33, 64, 65, 130, 700)]
    rows = []
    for k in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 1, 1, 2])):
                line = _changed(rng, line, alphabet) if line else "x"
            lines.append(line)
        rows.append((k, "\n".join(lines)))
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[5][1]), (61, None), (62, "")]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = _brute(rows)
    assert len(got) == len(rows)
    # the text given back names its row by id; rows equal in id and text are one document
    for doc in {r[0] for r in rows}:
        assert sorted(repr(r["text"]) for r in got if r["doc_id"] == doc) == sorted(repr(want.get(r, r[1])) for r in rows if r[0] == doc)


def test_one_edit(spark):
    rng = random.Random(33)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("ab中🙂", k=rng.randrange(0, 9)))
        b = _changed(rng, a, "ab中🙂") if a and rng.random() < 0.8 else "".join(rng.choices("ab", k=rng.randrange(0, 9)))
        pairs.append((a, _changed(rng, b, "ab") if b and rng.random() < 0.3 else b))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within_one_edit(F.col("a"), F.col("b")).alias("near")).collect()
    assert {r["near"] for r in rows} == {True, False} and all(r["near"] == _near(r["a"], r["b"]) for r in rows)


def test_very_long_lines(spark):
    rng = random.Random(32)
    long = "".join(rng.choices("abcdefgh ", k=50_000))
    other = "".join(rng.choices("abcdefgh ", k=50_000))
    texts = [long, long[:40_000] + "x" + long[40_001:], long[:123] + long[124:], long + "\n" + other, other[:-1], "y" + other, "a" * 1_000_000, "a" * 999_999, "\n" * 300_000 + "tail"]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_kept"]) for r in line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == (long, 1, 1) and got[3] == (other, 2, 1) and got[6] == (texts[6], 1, 1) and got[8] == (texts[8], 1, 1)
    assert all(got[k] == ("", 1, 0) for k in (1, 2, 4, 5, 7))


def test_many_lines_in_one_document(spark):
    text = "\n".join(f"line {k:06d} of one text, {k * 7919 % 100003}" for k in range(100_000))
    got = line_dedup.line_dedup(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()
    kept = {r["doc_id"]: (r["n_lines"], r["n_kept"]) for r in got}
    assert kept[1][0] == kept[2][0] == 100_000 and kept[2][1] == 0 and 0 < kept[1][1] <= 100_000


@pytest.mark.parametrize("text", [">" * 1_000_000, " " * 1_000_000, "x@a." + "a." * 400_000, "\n" * 1_000_000])
def test_texts_of_one_character(spark, text):
    got = line_dedup.line_dedup(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [r["text"] for r in got] == [text]


def test_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same line", 5, 6, 7, 8), (2, "same line\nnew", 1, 2, 3, 4)], "doc_id int, text string, n_lines int, kept int, `h1` int, `a.b` int")
    got = sorted(map(tuple, line_dedup.deduplicated(docs).collect()))
    assert got == [(1, "same line", 5, 6, 7, 8), (2, "new", 1, 2, 3, 4)] and line_dedup.deduplicated(docs).columns == docs.columns
    assert line_dedup.line_dedup(docs).columns == ["doc_id", "text", "kept", "h1", "a.b", "n_lines", "n_kept"]
    assert line_dedup.line_dedup(spark.createDataFrame([], DOCS)).count() == 0
    assert re.search("n_kept", str(line_dedup.line_dedup(spark.createDataFrame([], DOCS)).schema))
