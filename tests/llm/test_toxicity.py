from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import toxicity
from tierlake.llm.common import is_held_out, table

SF = "/root/testdata/sf0.01"
TAGGER = toxicity.Model().tagger()


def _symbols(text):
    return {toxicity.ORDER[s]: n for s, n in toxicity.symbols_of(text, TAGGER).items()}


def test_grammar_reads_clauses():
    assert _symbols("you are an idiot") == {"insult+aimed": 1}
    assert _symbols("an idiot wrote this") == {"insult": 1}
    assert _symbols("you are not stupid") == {"insult+negated": 1}
    assert _symbols("he said it was stupid") == {"insult+reported": 1}
    assert _symbols("He said so. It was stupid") == {"insult": 1}, "a report ends with its clause"
    assert _symbols("I will hurt you") == {"threat": 1}
    assert _symbols("I will never hurt you") == {"threat+negated": 1}
    assert _symbols("Kill him") == {"threat": 1}
    assert _symbols("the movie will hurt nobody") == {}
    assert _symbols(None) == _symbols("") == {}


def test_composed_machine_equals_its_parts():
    for tags in itertools.product(range(1, toxicity.TAGS), repeat=4):
        states, at = [s for _, s in toxicity.MACHINES], 0
        for tag in tags:
            marks = set()
            for i, (step, _) in enumerate(toxicity.MACHINES):
                states[i], mark = step(states[i], tag)
                marks.add(mark)
            assert toxicity.SYMBOL[at][tag] == toxicity._symbol(marks)
            at = toxicity.NEXT[at][tag]


def test_stems_are_learned_for_inflected_forms(spark):
    clean = [(i, f"bla{i % 29} dum{i % 5} tra{i % 11}", 0) for i in range(400)]
    bad = [(1000 + i, f"bla{i % 29} grumpf{'abcdefghijklm'[i % 13]}x dum{i % 5} x{i}", 1)
           for i in range(80)]
    rows = spark.createDataFrame(clean + bad, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert "grumpf" in model.stems
    new = spark.createDataFrame([(1, "dum1 grumpfzz bla1"), (2, "dum1 bla1")],
                                "doc_id bigint, text string")
    got = {r.doc_id: r.predicted for r in toxicity.score(new, model).collect()}
    assert got == {1: 1, 2: 0}


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter(
        "held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert got >= 0.95


def test_odd_rows(spark, documents):
    docs = documents(ODD)
    model = toxicity.Model()
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == 0 and not r.held_out for r in got
               if r.doc_id is None)
    labels = spark.createDataFrame([(0, None), (None, 1), (1, 1)], "doc_id bigint, toxic int")
    assert toxicity.fit(docs, labels) == model, "one class only: the prior"
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs.limit(0), labels.limit(0)) == model


def test_rejects_what_it_scores_toxic(spark, documents):
    docs = documents(["a fine day", "you are a stupid idiot. You worthless scum!", None])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.doc_id for r in toxicity.reject_toxic(docs, none).collect()] == [0, 2]


def test_no_held_out_row_is_learned_from(spark):
    docs = table(spark, SF, "documents")
    rows = toxicity.training_rows(docs, table(spark, SF, "labels"), 10**6)
    assert rows.filter(is_held_out()).count() == 0 and rows.count() > 0
