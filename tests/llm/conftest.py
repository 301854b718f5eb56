from __future__ import annotations

import pytest
from llm_cases import ODD
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
