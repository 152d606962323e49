from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import language_id
from tierlake.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = language_id.predict(docs, language_id.fit(docs)).join(docs, "doc_id")
    held = got.filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held >= 0.98


def test_batched_product_is_the_kernel():
    """The presence matrix gives the normalised number of common n-grams."""
    texts = [language_id.normal(t) for t in ("Abc abd", "bcd, abc", "xyz")]
    spectrum = language_id.spectrum_of(texts, texts, 80)
    rows = spectrum.presence(texts)

    def grams(text):
        return {text[i:i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            exact = len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
            assert abs(float(rows[i] @ rows[j]) - exact) < 1e-5


def test_numbers_are_no_letters(documents):
    docs = documents(["½ ²", "Ⅷ ③", "12_3", "x²"] + ["the cat sat on the mat"] * 20)
    got = {r.doc_id: (r.lang_pred, r.score)
           for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert got[3][0] == "en"


def test_odd_rows(spark, documents):
    docs = documents(ODD + [(i, "the cat sat on the mat") for i in range(10, 20)])
    model = language_id.fit(docs)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(ODD) + 10
    assert {r.lang_pred for r in got} == {"und", "en"}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    none = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(unlabelled).languages == []
    assert language_id.predict(docs.limit(0), model).count() == 0
