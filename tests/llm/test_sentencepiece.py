from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from tests.llm.conftest import ODD
from tierlake.llm import sentencepiece_bpe as s
from tierlake.llm.queries import pieces_path


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces_path())


@pytest.fixture(scope="module")
def codec():
    return s.Codec(s.read_vocabulary(pieces_path()))


def test_equals_the_library(library, codec):
    rng = random.Random(1)
    letters = "aàé▁ \n\t  etio.,:;'\"0123ABñß字😀漢ﬁ\u0000​<s>x"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(chr(rng.randint(1, 0xd7ff)) for _ in range(50)) for _ in range(200)]
    texts += ["", " ", "   ", "\n\n", "<s>", "a" * 5000, " " * 700, "ab " * 700, None]
    for text in texts:
        ids = codec.encode(text)
        assert ids.tolist() == library.encode(text or "")
        assert codec.decode(ids) == library.decode(ids.tolist())


def test_decodes_any_ids(library, codec):
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000)]) for _ in range(12)]
        assert codec.decode(np.array(ids)) == library.decode(ids)


def test_prefix_table_names_the_last_token(library, codec):
    text = "▁internationalisation"
    last = codec.last_tokens(text)
    for end in range(1, len(text) + 1):
        assert codec.vocabulary.names[last[end]] == s.merge(text[:end], codec.vocabulary)[-1]


def test_forgetting_changes_nothing(library, codec, monkeypatch):
    monkeypatch.setattr(s, "REMEMBERED", 3)
    monkeypatch.setattr(s, "REMEMBERED_PAIRS", 5)
    small = s.Codec(codec.vocabulary)
    for text in ("the quick brown fox jumps over the lazy dog " * 3, "né à Übersee\n" * 4):
        assert small.encode(text).tolist() == library.encode(text)


def test_slices_are_decoded_at_once(library, codec):
    texts = ["", "né à Übersee 漢字😀", " ", "", "a  b\n\u0000c", "\ufffd ▁x", ""]
    made = [codec.encode(t) for t in texts] + [  # and ids that no text has: parts of characters
        np.array(ids, dtype=np.int32) for ids in ([3 + 0xe6, 3 + 0xbc], [300, 3 + 0xff, 301])]
    for rows in (made[:len(texts)], made, made[:1], []):
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        got = codec.decode_all(np.concatenate([np.empty(0, np.int32), *rows]), ends)
        assert got.to_pylist() == [library.decode(ids.tolist()) for ids in rows]


def test_shared_beginnings_change_nothing(library, codec, monkeypatch):
    """Tables of cuts go on from those of their beginnings, and steps that are not remembered."""
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinsh.,é", k=rng.randint(1, 39))) for _ in range(300)]
    words += [w[:rng.randint(1, 12)] + v for w, v in zip(words, words[1:])]
    tables = [codec.last_tokens(w) for w in words]
    assert codec.tables and all(len(b) <= s.SHORT for b in codec.tables)
    monkeypatch.setattr(s, "REMEMBERED_TABLES", 2)
    monkeypatch.setattr(s, "REMEMBERED_STEPS", 5)
    small = s.Codec(codec.vocabulary)
    assert [small.last_tokens(w) for w in words] == tables
    assert len(small.tables) <= 2 and small.automaton.n_steps == 5
    for word in words:
        assert small.encode(word).tolist() == library.encode(word)


def test_odd_rows(documents, library):
    docs = documents(ODD)
    got = s.encode_and_decode(docs, pieces_path()).collect()
    assert len(got) == len(ODD)
    want = sorted((str(i), library.encode(t or "")) for i, t in ODD)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert s.encode_and_decode(docs.limit(0), pieces_path()).count() == 0
