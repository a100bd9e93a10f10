from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids by place), (id, text) pairs, or (id, text, source)."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, source = (*row, "s")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
