from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import quality_hosts as q


def brute_force(text):
    text = text or ""
    words = q.WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1
               for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if q.WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in q.SYMBOLS for c in text), dup, len(covered))


def test_measures():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab#") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += ["\n".join(rng.choice(["x y", "z", "", " ", "|<>"]) for _ in range(9))
              for _ in range(50)]
    for text in [*texts, None, "", "\n\n", "a b c", "a " * 16]:
        assert q.measure(text) == brute_force(text)


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)]
    rows += [(100 + i, bad if i % 10 else good, "spam") for i in range(100)]
    rows += [(200, good, "tiny"), (201, good, None), (202, bad, None), (203, bad, "small")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert len(got) == len(rows)
    assert got[1].kept and not got[0].kept and got[0].base_failed
    assert not got[100].kept and not got[100].base_failed, "a good text of a bad host"
    assert got[200].kept and got[201].kept and not got[202].kept
    assert got[201].host_rate is None
    # Shrunk towards the mean of all hosts (about a half), not 1 and not 0.
    assert 0.05 < got[200].host_rate < 0.5 < got[203].host_rate < 0.95
    assert 0.1 < got[1].host_rate < 0.12 and 0.88 < got[100].host_rate < 0.9


def test_host_far_above_the_usual_rate(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    hosts = {"clean": (1000, 0), "usual": (300, 30), "worse": (200, 80), "few": (4, 2)}
    rows = [(bad if i < fails else good, host) for host, (texts, fails) in hosts.items()
            for i in range(texts)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "doc_id bigint, text string, source string")
    kept = Counter(rows[r.doc_id][1] for r in q.judge(docs).collect() if r.kept)
    assert kept == {"clean": 1000, "usual": 270, "few": 2}, "two failures of four prove nothing"
    # By hand: the prior from all hosts, then each host's posterior against the usual rate.
    rates = [(n, f / n) for n, f in hosts.values()]
    total = sum(n for n, _ in rates)
    mean = sum(n * p for n, p in rates) / total
    noise = mean * (1 - mean)
    between = ((sum(n * (p - mean) ** 2 for n, p in rates) - (len(rates) - 1) * noise)
               / (total - sum(n * n for n, _ in rates) / total))
    strength = min(max(noise / max(between, 1e-6) - 1, 1), 1e6)
    for r in q.host_rates(q.measures(docs)).collect():
        n, fails = hosts[r.host]
        shrunk = (fails + mean * strength) / (n + strength)
        assert r.shrunk == pytest.approx(shrunk) and r.usual == pytest.approx(mean)
        assert r.spread == pytest.approx((shrunk * (1 - shrunk) / (n + strength + 1)) ** 0.5)


def test_odd_rows(documents):
    docs = documents(ODD)
    got = q.judge(docs, "host").collect()
    assert len(got) == len(ODD)
    assert {r.doc_id for r in got if not r.base_failed} == set()
    assert q.judge(docs.limit(0)).count() == 0
    nowhere = docs.withColumn("source", F.lit(None).cast("string"))
    assert q.judge(nowhere).filter("host_rate is not null").count() == 0
