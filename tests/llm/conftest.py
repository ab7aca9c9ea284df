from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (id, text) pairs, with columns that could clash."""

    def make(texts, **more):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, more.get("lang", "en"), "s", None if t is None else len(t), "x", 1, 2.0) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", ids string, spans int, score double").repartition(3)

    return make


@pytest.fixture
def rows_of():
    """Rows as dictionaries, ordered by the text of a column."""

    def read(df, key="doc_id"):
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r[key] is not None, r[key]))

    return read
