from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside or add; tables may have them too.
CLASHES = ("score", "hash", "host", "words", "runs", "n", "held_out", "kept", "sid", "node")


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text), with clashing extra columns."""
    def make(texts, clash=True):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(*r, "en", f"src{i % 3}", len(r[1] or "")) for i, r in enumerate(rows)]
        df = spark.createDataFrame(rows, DOCUMENTS)
        if clash:
            for name in CLASHES:
                from pyspark.sql import functions as F
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


#: Nulls, empty and blank texts, a repeated row, a null id, ties, one very long text.
ODD = [(0, None), (1, ""), (2, " \n\t\n "), (3, "one two"), (3, "one two"), (None, "one two"),
       (None, None), (4, "a " * 30_000), (5, "x" * 50_000), (6, "é ß ñ 漢字 😀 .")]
