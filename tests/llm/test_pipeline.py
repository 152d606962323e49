"""The pipeline, stage by stage, on a small corpus with planted cases."""
from __future__ import annotations

import random

import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.conftest import DOCUMENTS
from tests.llm.test_jaccard_join import brute_force
from tierlake.llm.queries import QUERIES, pieces_path


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdgklmnprst" for b in "aeiou" for c in "lmnrst"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, prose(20) + ". " + prose(8)) for i in range(12)]
    passage = prose(70)
    texts, kind = [], []

    def add(text, what):
        texts.append(text)
        kind.append(what)

    for i in range(60):
        add("\n".join(prose(30) for _ in range(4)), "clean")
    for i in range(12):
        add(prose(30) + " you stupid idiot. You are worthless scum " + prose(20), "toxic")
    for i in range(6):
        add(f"{prose(40)}\n{passage}\n{prose(40)}", "passage")
    for i in range(5):
        words = texts[i].split(" ")
        words[45], words[75] = f"other{i}", f"new{i}"  # no run of 50 words is left alike
        add(" ".join(words), "near")
    for i in range(5):
        add(prose(50) + " " + items[i][1] + " " + prose(50), "leak")
    add(texts[0], "exact")
    add(None, "null")
    add("", "empty")
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(k == "toxic")) for i, k in enumerate(kind)],
                          "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, texts, kind, passage


def test_each_stage_takes_out_what_it_should(spark, corpus):
    folder, texts, kind, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    gone = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        path = f"{folder}/stage-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        if number < 4:
            assert docs.columns == columns
        gone.append({kind[i] for i in set(before) - set(after)})
        if name == "line_dedup":
            assert sum(passage in (r.text or "") for r in after.values()) == 1
            assert all(r.n_chars == len(r.text or "") for r in after.values())
            assert all(after[i].text == texts[i] for i in after if kind[i] == "clean")
        if name == "jaccard_join":
            classes = brute_force([(i, r.text) for i, r in before.items()])
            assert set(after) == {c for c, _ in classes.values()}
        if name == "sentencepiece":
            library = sentencepiece.SentencePieceProcessor(model_file=pieces_path())
            for i, r in after.items():
                assert r.ids == library.encode(before[i].text or "")
                assert r.decoded == (before[i].text or "") and r.n_tokens == len(r.ids)
    assert gone == [{"toxic"}, {"exact"}, {"near"}, {"leak"}, set()]


def test_run_equals_its_stages(spark, corpus):
    folder = corpus[0]
    got = sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, folder).collect())
    want = spark.read.parquet(f"{folder}/stage-{corpus_pipeline.STAGES[-1][0]}").collect()
    assert got == sorted((r.doc_id, r.ids) for r in want)


def test_one_query_for_each_operator():
    import __spark_entry__ as driver
    names = [n for n in driver.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(QUERIES) <= set(driver.queries()) and "pipeline" in driver.queries()
