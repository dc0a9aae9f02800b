from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, ids string"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those of the operators."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1.0, "x", "y") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"wörd{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "same text here now"), (6, "same text here now")]
    return docs([*rows, (6, "same text here now"), (None, "no id at all"), (None, None), (7, "x" * 200_000)])
