"""Importance resampling against a plain computation of every step."""
from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import importance


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [crc32(f.encode()) % 10_000 for f in
                        words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def by_hand(docs, target, percent=25, min_words=20):
    corpus = Counter(b for _, t in docs for b in features(t)[1])
    wanted = Counter(b for t in target for b in features(t)[1])
    s, t = sum(corpus.values()) + 10_000, sum(wanted.values()) + 10_000
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        gain = sum(math.floor(1000 * math.log((wanted[b] + 1) * t ** -1 * s / (corpus[b] + 1)))
                   for b in found)
        weight = gain // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n])
    eligible = sorted((r for r in rows if r[5] >= min_words),
                      key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[:percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    common = [f"word{i}" for i in range(300)]
    rare = [f"Été{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choice(rare if rng.random() < i % 7 / 10 else common)
                         for _ in range(rng.randrange(10, 90)))) for i in range(400)]
    docs += [(500 + i, "the same text " * 10) for i in range(100)]  # equal weights
    docs += [(700, docs[0][1])] * 60  # one id, one score
    return docs + ODD, [" ".join(rng.choice(rare) for _ in range(50)) for _ in range(20)] + [None]


def run(spark, documents, docs, target, **options):
    table = documents(docs).withColumn("rank", F.lit(0)).repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(table, importance.fit(table, items), **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, found.collect()), key=str)


def test_rows_are_those_of_the_plain_computation(spark, documents, corpus):
    docs, target = corpus
    assert run(spark, documents, docs, target) == by_hand(docs, target)
    assert run(spark, documents, docs, target, percent=100, min_words=0) == by_hand(
        docs, target, 100, 0)


def test_small_and_empty_tables(spark, documents, corpus):
    docs, target = corpus
    assert run(spark, documents, [], target) == []
    assert run(spark, documents, ODD, []) == by_hand(ODD, [])
    assert run(spark, documents, docs[:4], target, percent=50, min_words=1) == by_hand(
        docs[:4], target, 50, 1)


def test_brackets_are_widened_until_they_hold_the_rank(spark):
    scores = spark.range(1000).select((F.col("id") * F.col("id")).alias("score"))
    for wanted in (1, 2, 250, 999, 1000):
        low, high, above = importance.bracket(scores, wanted, 1000, margin=0.0)
        value = (1000 - wanted) ** 2
        assert (low is None or low <= value) and (high is None or value <= high)
        assert above == (0 if high is None else scores.filter(F.col("score") > high).count())
        assert above < wanted
    same = spark.range(500).select(F.lit(7).cast("bigint").alias("score"))
    assert importance.bracket(same, 100, 500)[2] == 0


def test_ranks_go_on_over_partitions(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 13).alias("score"), F.col("id").alias("spread"))
    got = importance.numbered(rows.repartition(7), "test").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [r["doc_id"] for r in got] == sorted(range(5000), key=lambda i: (-(i % 13), i))
