"""Copies whose ids are null or repeat."""

from millrace.llm import jaccard


def test_copies_without_an_id_or_with_one_id(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text)] * 5 + [(7, text), (7, text + " x"), (3, "other words only"), (3, "something else entirely here"), (None, "alone"), (None, None), (9, "")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    mine = [(r["doc_id"], r["text"]) for r in got]
    big = [m for m in mine if m[1] and m[1].startswith(text)]
    assert len(big) == 1 and big[0][0] == 7
    assert sorted(map(repr, set(mine) - set(big))) == sorted(map(repr, set(rows[7:]))) and len(mine) == 6
