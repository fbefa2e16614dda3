from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        T.StructField("key", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("component_id", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns of clashing names."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1]), "k", 1, "c") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
