"""Fill-in-the-middle: the rank index against plain offsets, the rows against plain slicing."""
from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import ODD
from tierlake.llm.fill_middle import EPSILON, boundaries, fit, restore, transform

MIXED = "plain ascii " * 300 + "漢字" * 400 + "é" * 200 + "😀a" * 300


def plain_offsets(text):
    return np.cumsum([0, *(len(c.encode()) for c in text)])


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400), st.integers(1, 100))
def test_every_boundary_is_exact(text, epsilon):
    index = fit(boundaries(text.encode()), epsilon)
    expected = plain_offsets(text)
    assert (index.offset(np.arange(len(expected))) == expected).all()
    assert np.abs(index.predict(np.arange(len(expected))) - expected).max() <= epsilon + 1


def test_segments_grow_with_changes_of_script_not_with_length():
    for text, most in (("abc" * 100_000, 1), ("漢" * 100_000, 1), (MIXED, 12),
                       ("a" * 50_000 + "漢" * 50_000, 3)):
        index = fit(boundaries(text.encode()))
        assert len(index.first) <= most
        expected = plain_offsets(text)
        assert (index.offset(np.arange(len(expected))) == expected).all()
        assert index.residual.dtype == np.int8 and EPSILON < 127


def by_hand(doc_id, text, percent=90, spm=20, seed=1):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < spm else "psm"
    output = (f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm"
              else f"<P>{prefix}<S>{suffix}<M>{middle}")
    return doc_id, n, form, a, b - a, output, text


def test_rows_are_cut_as_by_hand(spark, documents):
    texts = [*ODD, (20, MIXED), (21, "<P> in it"), (22, "<M"), (23, "< S><"), (24, "á‍")]
    texts += [(i, f"text {i} é") for i in range(100, 160)]
    got = sorted(map(tuple, transform(documents(texts)).collect()), key=str)
    assert got == sorted((by_hand(i, t) for i, t in texts), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    every = transform(documents(texts), percent=100, spm_percent=100, seed=5).collect()
    assert sorted(map(tuple, every), key=str) == sorted(
        (by_hand(i, t, 100, 100, 5) for i, t in texts), key=str)
    assert transform(documents(texts).limit(0)).collect() == []


def test_outputs_restore_where_parts_end_like_markers():
    for form, output in (("psm", b"<P>a<S<S>b<M<M>c<"), ("spm", b"<S>b<P<P>a<M<M>c")):
        assert restore(output, form) in (b"a<Sc<b<M", b"a<Mcb<P")
