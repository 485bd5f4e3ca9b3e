"""Labels that name more languages than the table may have columns."""

import pytest

from millrace.llm import language


def test_no_language_is_dropped(spark):
    docs = spark.createDataFrame([(k, f"text number {k}", f"l{k % 5}") for k in range(25)], "doc_id long, text string, lang string")
    assert language.fit(docs, max_languages=5).languages == [f"l{k}" for k in range(5)]
    with pytest.raises(ValueError, match="more than 4 languages"):
        language.fit(docs, max_languages=4)
