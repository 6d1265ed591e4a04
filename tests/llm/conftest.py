from __future__ import annotations

import pytest
from pyspark.sql import types as T


TEXTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs or of longer rows."""

    def make(*rows: tuple):
        full = [(*row, *("en", "s0", None)[len(row) - 2 :]) for row in rows]
        return spark.createDataFrame(full, TEXTS)

    return make
