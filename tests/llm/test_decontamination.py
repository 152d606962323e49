from __future__ import annotations

import random
from collections import Counter

import numpy as np

from tests.llm.conftest import ODD
from tierlake.llm import decontamination as d


def _index(items):
    counts, segments = Counter(), [s for _, t in items for s in d.segments_of(t)]
    for s in segments:
        counts.update(set(s))
    return d.build_index(items, counts, len(segments), sum(map(len, segments)) / len(segments))


def _sentence(rng, n, words=200):
    return " ".join(f"w{int(rng.random() ** 2 * words)}" for _ in range(n))


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(1)
    index = _index([(i, _sentence(rng, rng.randint(5, 90))) for i in range(150)])
    for _ in range(60):
        words = _sentence(rng, 120).split()
        query = np.unique([index.terms[w] for w in words if w in index.terms])
        scores = np.zeros(len(index.owner))
        for term in query:
            segments, impacts = index.postings[term]
            scores[segments] += impacts
        for threshold in (.05, .2, .4, .8):
            got = d.block_max_wand(index, query, threshold)
            want = np.flatnonzero(scores >= threshold - 1e-9)
            assert [s for s, _ in got] == want.tolist()
            assert np.allclose([v for _, v in got], scores[want])


def test_planted_items_are_found_and_nothing_else(spark, documents):
    rng = random.Random(2)
    items = [(i, _sentence(rng, rng.choice([4, 15, 40, 130]), 4000) + ". "
              + _sentence(rng, 5, 4000)) for i in range(40)]
    texts, truth = [], set()
    for i in range(80):
        parts = [_sentence(rng, rng.randint(0, 400), 4000), _sentence(rng, 150, 4000)]
        if i % 4 == 0:
            item, text = rng.choice(items)
            truth.add((i, item))
            text = text.upper() if i % 8 else text.replace(" ", "\n")
            parts.insert(1, text)
        elif i % 4 == 1:  # the question alone is no leak, nor are its words in another order
            text = rng.choice(items)[1]
            parts.insert(1, text.split(". ")[0])
            parts.append(" ".join(rng.sample(text.split(), len(text.split()))))
        texts.append(" ".join(parts))
    docs = documents(texts)
    benchmark = spark.createDataFrame([*items, (99, None), (98, ""), (1, items[1][1])],
                                      "item_id bigint, text string")
    found = d.find_leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == truth
    sharded = d.find_leaks(docs, benchmark, shard=7)
    assert sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in sharded.collect()) == sorted(
        (r.doc_id, r.item_id, round(r.score, 9)) for r in found.collect())
    kept = d.drop_contaminated(docs, benchmark, shard=7)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(80)) - {i for i, _ in truth}


def test_shards_know_words_that_spark_would_cut_otherwise(spark, documents):
    odd = ["x² plus ½ of ③", "हिन्दी में प्रश्न", "cafe\u0301 au lait", "a\u200db c\u203fd", "İSTANBUL ΟΔΟΣ ǅ"]
    items = [(i, f"{text} and the words of item number {i}. The answer is {text}")
             for i, text in enumerate(odd)]
    docs = documents([f"before it {text} after it" for _, text in items])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = sorted((r.doc_id, r.item_id, round(r.score, 9))
                      for r in d.find_leaks(docs, benchmark).collect())
    assert {(i, i) for i in range(len(odd))} <= {r[:2] for r in expected}
    assert sorted((r.doc_id, r.item_id, round(r.score, 9))
                  for r in d.find_leaks(docs, benchmark, shard=2).collect()) == expected
    assert d.drop_contaminated(docs, benchmark, shard=2).count() == 0


def test_odd_rows(spark, documents):
    docs = documents(ODD)
    benchmark = spark.createDataFrame([(1, "one two"), (2, "")], "item_id int, text string")
    got = d.find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(3, 1), (None, 1)}
    assert d.drop_contaminated(docs, benchmark).count() == len(ODD) - 3
    assert d.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert d.drop_contaminated(docs, benchmark.limit(0)).count() == len(ODD)
    assert d.find_leaks(docs.limit(0), benchmark).count() == 0
