from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A small documents table; rows give what they need, the rest is null."""

    def table(rows, schema=DOCS):
        width = len(T.StructType.fromDDL(schema).fields)
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return table
