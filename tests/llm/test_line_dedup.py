from __future__ import annotations

import random

import pytest

from tests.llm.conftest import ODD
from tierlake.llm import line_dedup


def brute_force(texts, least):
    """Lines deleted of each text: members of runs with enough words that began before."""
    seen, deleted = set(), [set() for _ in texts]
    for number, text in enumerate(texts):
        lines = line_dedup.content_lines(text)
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(lines[i:j])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        deleted[number] |= set(range(i, j))
                    seen.add(run)
    return deleted


def _texts(seed):
    rng = random.Random(seed)
    words = ["a b", "c", "d e f", "g", "h i j k l", "m", "", "n o", " "]
    texts = []
    for i in range(50):
        lines = [rng.choice(words) for _ in range(rng.randint(0, 12))]
        if rng.random() < .3:
            lines = [f"u{i} {k}" if rng.random() < .3 else x for k, x in enumerate(lines)]
        if texts and rng.random() < .3:
            copied = rng.choice(texts).split("\n")
            lines = lines[:4] + copied[:rng.randint(0, len(copied))]
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("seed,least", [(0, 3), (1, 6), (2, 9), (3, 14)])
def test_brute_force(documents, seed, least):
    texts = _texts(seed)
    expected = brute_force(texts, least)
    docs = documents(texts)
    made = line_dedup.delete_copies(docs, least, "n_gone")
    assert made.columns == [*docs.columns, "n_gone"]
    for row in made.collect():
        gone = expected[row.doc_id]
        assert row.n_gone == len(gone)
        kept = [x for i, x in enumerate(line_dedup.content_lines(texts[row.doc_id]))
                if i not in gone]
        assert line_dedup.content_lines(row.text) == kept
        if not gone:
            assert row.text == texts[row.doc_id]


def test_shortest_runs_cover_every_long_run():
    rng = random.Random(5)
    import numpy as np
    for _ in range(200):
        words = np.array([rng.randint(1, 5) for _ in range(8)])
        least = rng.randint(1, 15)
        runs = set(line_dedup.shortest_runs(words, np.arange(8, 0, -1), least))
        for i in range(8):
            for j in range(i + 1, 9):
                if words[i:j].sum() >= least:
                    inside = [(s, m) for s, m in runs if s >= i and s + m <= j]
                    assert set().union(*(range(s, s + m) for s, m in inside)) == set(range(i, j))


def test_ordered_ranks_follow_the_pairs(spark):
    pairs = spark.createDataFrame([(i % 7, i % 5) for i in range(100)], "rank int, second int")
    rows = sorted(map(tuple, line_dedup._repeated_in_order(pairs, ["rank", "second"]).collect()))
    assert len(rows) == 35 and [r[2] for r in rows] == sorted(r[2] for r in rows)


def test_odd_rows(documents):
    docs = documents(ODD)
    got = line_dedup.delete_copies(docs, 2, "gone").collect()
    assert len(got) == len(ODD)
    by = {(r.doc_id, r.text, r.gone) for r in got}
    assert (0, None, 0) in by and (1, "", 0) in by and (2, " \n\t\n ", 0) in by
    assert (None, "one two", 0) in by, "a null id comes first"
    assert [r.text for r in got if r.doc_id == 3] == ["", ""], "repeated rows, one result"
    assert line_dedup.delete_copies(docs.limit(0)).count() == 0
    assert docs.schema == line_dedup.delete_copies(docs).schema


def _words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_passages_that_begin_or_end_within_lines(documents):
    passage = _words("p", 55)
    split = passage.split()
    texts = ["\n".join(["head " + " ".join(split[:25]), " ".join(split[25:])]),
             f"{_words('a', 9)} {passage} {_words('b', 9)}\nlast line",
             f"{_words('c', 20)}\n{_words('d', 12)} " + " ".join(split[:30]) + "\n\n"
             + " ".join(split[30:]) + f" {_words('e', 12)}",
             f"{_words('f', 30)} {' '.join(split[:49])} {_words('g', 30)}",
             f"{_words('h', 60)} {_words('k', 8)} {_words('h', 60)}",
             "two words\n" + " ".join(split[:50]) + " end"]
    made = {r.doc_id: (r.text, r.gone)
            for r in line_dedup.delete_copies(documents(texts), count_as="gone").collect()}
    assert made[0] == (texts[0], 0), "the first copy stays"
    assert made[1] == (f"{_words('a', 9)} {_words('b', 9)}\nlast line", 1)
    assert made[2] == (f"{_words('c', 20)}\n{_words('d', 12)}\n\n{_words('e', 12)}", 2)
    assert made[3] == (texts[3], 0), "49 words are no passage"
    assert made[4] == (f"{_words('h', 60)} {_words('k', 8)}", 1)
    assert made[5] == ("two words\nend", 1)


def test_words_are_those_of_split():
    import pyarrow as pa
    from tierlake.llm.passages import Words
    rng = random.Random(3)
    parts = [c for c in map(chr, range(0x3100)) if c.isspace()] + 3 * [
        "a", "b", "\0", "é", "漢", "😀", "​", "‧", "Â", "z" * 8, "x" * 9, "y" * 70]
    texts = [None if rng.random() < .1 else "".join(rng.choices(parts, k=rng.randint(0, 30)))
             for _ in range(3000)]
    for column in (pa.array(texts), pa.array(["one", *texts])[1:], pa.array([None], pa.string())):
        made, all_texts = Words(column), column.to_pylist()
        words = [(i, w) for i, t in enumerate(all_texts) for w in (t or "").split()]
        assert made.owner.tolist() == [i for i, _ in words]
        cut = made.bytes.tobytes()
        assert [cut[a:b].decode() for a, b in zip(made.begin, made.end)] == [w for _, w in words]
        pairs = set(zip(made.ids.tolist(), (w for _, w in words)))
        assert len(pairs) == len({i for i, _ in pairs}) == len({w for _, w in words})
        first, stop = made.lines()
        assert (stop - first).tolist() == [
            len(x.split()) for t in all_texts for x in line_dedup.content_lines(t)]


def test_few_windows_are_compared(documents, monkeypatch):
    """Of stretches that several documents have only the first one's windows, of a text that
    repeats itself those of one round."""
    from tierlake.llm.common import Stored
    stored, tables = Stored.__call__, {}

    def counted(self, df, label):
        made = stored(self, df, label)
        tables.setdefault(label, []).append(made.count())
        return made

    monkeypatch.setattr(Stored, "__call__", counted)
    words = _words("n", 400).split()
    near = [" ".join([*words[:200], f"changed{i % 2}", *words[201:]]) for i in range(40)]
    texts = [*near, " ".join(["la", "li", "lu"] * 1000)]
    made = {r.doc_id: r.gone
            for r in line_dedup.delete_copies(documents(texts), count_as="gone").collect()}
    assert made == {0: 0} | {i: 1 for i in range(1, 41)}
    # Before: all windows around the change of all copies, and all 2,951 of the last text.
    assert sum(tables["windows"]) < 1000
