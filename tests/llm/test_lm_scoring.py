from __future__ import annotations

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import lm_scoring
from tierlake.llm.common import BATCH_BYTES, Stored, in_batches
from tierlake.llm.queries import LM_SQL, op3_lm_scoring

SF = "/root/testdata/sf0.001"


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    expected = sorted(connection.sql(LM_SQL).fetchall())
    got = sorted(map(tuple, op3_lm_scoring(spark, SF).collect()))
    assert got == expected


def by_hand(texts, targets):
    """(n_words, ce_target, ce_background) of each text, counted one pair after another."""
    lines = [["<s>", *(t or "").lower().split()] for t in texts]
    known = {w for line in lines for w in line[1:]}

    def model(rows):
        pairs = Counter(p for line in rows for p in zip(line, line[1:]))
        single, before = Counter(), Counter()
        for (h, w), n in pairs.items():
            single[w] += n
            before[h] += n
        total = sum(single.values())

        def loss(h, w):
            base = (single[w] + 1) / (total + len(known))
            return -math.log((pairs[h, w] + lm_scoring.MU * base) / (before[h] + lm_scoring.MU))
        return loss

    models = model([lines[i] for i in targets]), model(lines)
    return [(len(line) - 1, *(sum(m(h, w) for h, w in zip(line, line[1:]))
                              / max(len(line) - 1, 1) for m in models)) for line in lines]


@pytest.mark.parametrize("common", [0, 1, 3, 1_500])
def test_brute_force(spark, documents, common):
    texts = ["a b a b c", "a b b", "c a b", "d d d e", None, "", "e", "A b Z a e",
             "f " * 40 + "g a", "f", "a b a b c"]
    rng = random.Random(5)
    texts += [" ".join(rng.choices("abcdefghijklmnop", range(16, 0, -1), k=rng.randint(0, 30)))
              for _ in range(40)]
    docs = documents(texts)
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 1, 0), (3, 1, 1), (7, 1, 0), (8, 1, 0), (8, 0, 0), (20, 1, 0),
         (21, 1, 0), (21, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in lm_scoring.score(docs, labels, common, share=1).collect()}
    for i, (n, target, background) in enumerate(by_hand(texts, [0, 1, 7, 20, 21])):
        assert got[i].n_words == n
        assert (got[i].ce_target, got[i].ce_background) == pytest.approx((target, background))
        assert got[i].score == pytest.approx(target - background)


def test_repeated_and_null_ids(spark):
    rows = [(1, "x y"), (1, "x y"), (None, "x z"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    expected = by_hand([t for _, t in rows], [0, 1])
    for common in (0, 2):
        got = lm_scoring.score(docs, labels, common, share=1).collect()
        assert Counter((r.doc_id, r.n_words, round(r.ce_target, 9), round(r.ce_background, 9))
                       for r in got) == Counter(
            (i, n, round(t, 9), round(b, 9)) for (i, _), (n, t, b) in zip(rows, expected))


def test_codes_are_cleared_when_many(monkeypatch):
    text = "a q w é r t y b q a u i o b"
    part = pa.RecordBatch.from_arrays([pa.array([text, None, "a q"])], names=["text"])
    _, _, before, expected = lm_scoring.Codes([]).of(part)
    assert before[0] == 1 and (expected < 0).all() and len(set(expected)) == 11
    monkeypatch.setattr(lm_scoring, "_FLUSH", 4)
    common = [int(expected[0]), int(expected[7])]  # a and b
    codes = lm_scoring.Codes(common)
    lengths, row, before, after = codes.of(part)
    assert lengths.tolist() == [14, 0, 2] and len(codes) <= 6
    assert after.tolist() == [common.index(c) if c in common else c for c in expected.tolist()]
    assert before[row == 2].tolist() == [codes.start, 0]


@pytest.mark.parametrize("hot", [1, 10_000])
def test_words_that_the_sample_missed(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(lm_scoring, "HOT_ROWS", hot)
    texts = ["a b " * 50, "c a b", "a a a d"]
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in lm_scoring.score(documents(texts), labels, 0).collect()}
    for i, expected in enumerate(by_hand(texts, [0])):
        assert (got[i].n_words, got[i].ce_target, got[i].ce_background) == pytest.approx(expected)


def test_odd_rows(spark, documents):
    docs = documents(ODD)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = lm_scoring.score(docs, labels).collect()
    assert len(got) == len(ODD)
    assert all(r.score == 0 for r in got if r.n_words == 0)
    assert lm_scoring.score(docs.limit(0), labels).count() == 0


def test_workers_hold_little_at_once(spark, documents):
    """The table of pairs, a batch of texts, and no second kind of workers beside these."""
    texts = documents(["a b a c", "b a"]).select("text", F.lit(True).alias("target"))
    _, (target, background) = lm_scoring.fit(texts, lm_scoring.frequent_words(texts, 10),
                                             Stored(spark))
    assert target.pairs.nbytes + background.pairs.nbytes <= 2 * 4 * target.pairs.size
    assert background.pairs.sum() == 6
    before, after = np.array([0, 1]), np.array([1, 2])
    assert background.ln_pairs(before, after) == pytest.approx(
        np.log(background.pairs + background.base)[before, after])

    labels = spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = spark.range(0, 3_000, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2_000).alias("text"))
    plan = lm_scoring.score(docs, labels)._jdf.queryExecution().toString()
    assert "LogicalRDD" not in plan and "ExistingRDD" not in plan

    def sizes(batches):
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array([part.nbytes])], names=["n"])

    found = [r.n for r in docs.mapInArrow(sizes, "n bigint").collect()]  # after score() as within
    assert sum(found) > 30_000_000 and max(found) < 1.1 * BATCH_BYTES
    assert in_batches(docs, sizes, "n bigint").count() == len(found)


def test_names_tell_words_apart():
    words = [b"a" * n for n in range(1, 60)] + [b"a" * n + b"\0" for n in range(1, 60)]
    words += [b"a" * n + b"b" + b"a" * (30 - n) for n in range(31)] + ["é".encode(), b"e", b"x y"[:1]]
    part = pa.RecordBatch.from_arrays([pa.array([
        " ".join(w.decode() for w in words), "\x0b\t a\x85b\x1cc d\r" + "É a" * 2])],
        names=["text"])
    lengths, _, _, codes = lm_scoring.Codes([]).of(part)
    assert lengths.tolist() == [len(words), 4]  # only ASCII's six characters are white space
    assert len(set(codes[:len(words)].tolist())) == len(set(words))
    assert codes[-1] == codes[0] and codes[len(words)] < 0
    assert codes[-3] == codes[words.index("é".encode())] and (codes < 0).all()


@pytest.mark.parametrize("common", [0, 3])
def test_buckets_change_nothing(spark, documents, monkeypatch, common):
    """Places go to Python in arrays, those of a word in one bucket of bounded size."""
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcdefghijklmnop", range(16, 0, -1), k=rng.randint(0, 30)))
             for _ in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)],
                                   "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(lm_scoring, "BUCKET", 50)
    monkeypatch.setattr(lm_scoring, "_CHARS", 100)
    made = lm_scoring.score(documents(texts), labels, common, share=1)
    assert "Window" not in made._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in made.collect()}
    for i, expected in enumerate(by_hand(texts, range(20))):
        assert (got[i].n_words, got[i].ce_target, got[i].ce_background) == pytest.approx(expected)
