from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import jaccard_join as j
from tierlake.session import materialise


def brute_force(rows, threshold=0.8):
    """doc_id -> (class id, links) of (doc_id, text)."""
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = defaultdict(lambda: 10**9)
    for i, (number, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], number)
    return {n: (least[find(i)], links[i]) for i, (n, _) in enumerate(rows)}


def test_chunks_without_sets_count_no_link_twice(documents, monkeypatch):
    monkeypatch.setattr(j, "LEAF", 4)
    monkeypatch.setattr(j, "TOKENS", 80)
    rows = _rows(3, groups=25, copies=5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.join_documents(documents(rows)).collect()}
    assert got == brute_force(rows)


def _rows(seed, groups=40, copies=6):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(1, 80))]
        for _ in range(rng.randint(1, copies)):
            changed = list(words)
            for _ in range(rng.randint(0, 2)):
                changed[rng.randrange(len(changed))] = f"n{rng.randrange(10**6)}"
            rows.append(" ".join(changed))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [0, 1])
def test_brute_force(documents, seed):
    rows = _rows(seed)
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.join_documents(documents(rows)).collect()}
    assert got == brute_force(rows)


def test_splitting_and_blocks(documents, monkeypatch):
    """Small limits, so that nodes split, large ones end by agreement, and blocks are dealt."""
    monkeypatch.setattr(j, "LEAF", 4)
    monkeypatch.setattr(j, "BLOCK", 8)
    rows = _rows(2, 12, 30)
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.join_documents(documents(rows)).collect()}
    assert got == brute_force(rows)


def test_recall_decides_the_runs():
    assert j.n_runs(0.8, 0.9) == 1 and j.n_runs(0.8, 0.99999) == 5
    assert j.n_runs(0.8, 0.9999999) > j.n_runs(0.8, 0.999)


@pytest.mark.parametrize("threshold,recall", [(0.5, 0.99999), (0.65, 0.99999)])
def test_other_thresholds(documents, threshold, recall):
    rows = _rows(5, 30, 5)
    got = {r.doc_id: (r.class_id, r.n_links)
           for r in j.join_documents(documents(rows), threshold, recall).collect()}
    assert got == brute_force(rows, threshold)


def test_what_cannot_be_promised_is_an_error():
    with pytest.raises(ValueError):
        j.n_runs(0.3, 0.99999)
    assert j.n_runs(0.3, 0.5) < 32
    # Sketches lose no more than a tenth of what the runs may.
    from math import comb
    for threshold in (0.5, 0.8):
        least = j.agreements(threshold, 0.99999)
        assert sum(comb(64, k) * threshold ** k * (1 - threshold) ** (64 - k)
                   for k in range(least)) <= 1e-6
        assert least > 8


def test_keeps_the_first_of_each_class(documents):
    rows = _rows(3)
    docs = documents(rows)
    kept = j.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for c, _ in brute_force(rows).values()}


def test_components_of_a_path(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(40) if i != 20]
    edges = spark.createDataFrame(pairs, "u binary, v binary")
    got = {bytes(r.sid)[0]: bytes(r.root)[0] for r in j.components(edges).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def test_odd_rows(documents):
    docs = documents(ODD)
    got = j.join_documents(docs).collect()
    assert len(got) == len(ODD)
    alike = [r for r in got if r.n_links]
    assert [(r.doc_id, r.class_id, r.n_links) for r in sorted(alike, key=str)] == [
        (3, 3, 2), (3, 3, 2), (None, 3, 2)]
    assert all(r.class_id == r.doc_id for r in got if not r.n_links)
    kept = j.keep_first(docs)
    assert kept.filter("text = 'one two'").count() == 2, "rows of one document stay together"
    assert kept.count() == len(ODD) - 1
    assert j.join_documents(docs.limit(0)).count() == 0
    assert j.keep_first(docs.filter(F.col("text").isNull())).count() == 2


def test_a_block_is_compared_in_little_memory(monkeypatch):
    rng = np.random.default_rng(0)
    lists = [np.unique(rng.integers(0, 60_000, 300)) for _ in range(1_024)]
    every = np.arange(len(lists))
    for rows, columns in ((every, every), (every[:500], every[500:])):
        tracemalloc.start()
        found = j.overlaps(lists, rows, columns)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60_000_000
        for a, b in zip(rng.integers(0, 250, 50), rng.integers(250, 500, 50)):
            assert found[a, b] == len(np.intersect1d(lists[rows[a]], lists[columns[b]]))
    monkeypatch.setattr(j, "CELLS", 1_024 * 7)
    found = j.overlaps(lists[:40], every[:40], every[:40])
    assert all(found[a, b] == len(np.intersect1d(lists[a], lists[b]))
               for a in range(40) for b in range(a))


def test_a_split_joins_the_sets_once(documents, monkeypatch):
    monkeypatch.setattr(j, "LEAF", 4)
    plans = []

    def stored(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")))
        return materialise(df, label)

    sets = materialise(j.text_sets(documents(_rows(2, 12, 30))).dropDuplicates(["sid"]), "sets")
    j.buckets(sets.select("sid", "size", "least"), 2, stored)
    assert [n for label, n in plans if label == "paths"] == [1] * j.DEPTH
    assert sum(n for _, n in plans) == 2 * j.DEPTH - 1
