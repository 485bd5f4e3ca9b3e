"""Tables whose only text, or only labelled text, has a few words."""

import pyarrow as pa
import pytest

from millrace.llm import jaccard, quality, text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n", range(1, 10))
def test_one_text_of_n_words(n):
    words = " ".join(f"w{k}" for k in range(n))
    stats = quality.measure(pa.array([words]))
    assert (stats["n_words"].tolist(), stats["n_repeat_words"].tolist()) == ([n], [0])
    for size in (3, 5):
        hashes, counts = text.shingles_of(pa.array([words]), size)
        beside, several = text.shingles_of(pa.array([words, "x " * 20]), size)
        assert counts.tolist() == [max(n - size + 1, 1)] == several[:1].tolist() and hashes.tolist() == beside[: counts[0]].tolist()


def test_a_table_of_one_short_text(spark):
    docs = spark.createDataFrame([(1, "only three words", "en", "a", 16)], SCHEMA)
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels) == []
    assert [(r["n_words"], r["kept"]) for r in quality.quality(docs, labels).collect()] == [(3, False)]
    assert quality.good_documents(docs, []).count() == 0
    assert [tuple(r) for r in jaccard.jaccard_components(docs).collect()] == [(1, 1, 1)]
