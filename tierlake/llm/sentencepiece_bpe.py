"""Encoding and decoding with a SentencePiece BPE vocabulary, in time linear in the text.

Merging gives each prefix of a text one encoding, and the encoding of a prefix that ends with
token t is the encoding of the rest followed by t. So it is enough to store each prefix's last
token: an Aho-Corasick automaton over the pieces names all tokens that end at a position, and the
one that holds is the one compatible with the last token of the prefix before it. Two tokens are
compatible if merging their joint characters gives just these two; this is decided once a pair
by merging (best score first, leftmost of equals) and remembered. Reading the table backwards
from the end recovers the ids.

A text is cut where no piece reaches across: before a run of spaces (no piece has a space after
another character) and around characters that are no piece and become bytes. Encodings of short
cuts are remembered, so frequent words cost one look-up. A slice of texts is decoded at once.

The vocabulary (pieces and scores) is read on the driver from the model file and broadcast; it is
as large as the model. Supported are BPE models with byte fallback, a dummy prefix, and a
normaliser that only writes spaces as U+2581, which is checked when the file is read. There are
no begin or end ids and no sampling.

Defined results: a null text is encoded as the empty one, with no ids; texts of any length are
encoded as a whole; rows are independent, so ids may be null or repeated; an empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import uuid
from array import array
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.common import map_texts, type_of

SPACE = "▁"
#: A worker remembers cuts of at most SHORT characters, at most twice REMEMBERED of them, and
#: verdicts on at most so many pairs of tokens, so many steps of the automaton, and the tables of
#: at most so many beginnings of such cuts, each STRIDE characters longer than the one before.
SHORT, REMEMBERED, REMEMBERED_PAIRS, REMEMBERED_STEPS = 40, 300_000, 500_000, 500_000
REMEMBERED_TABLES, STRIDE = 200_000, 4


def _utf8(data: bytes) -> str:
    """Decode characters; every byte that belongs to none becomes U+FFFD on its own."""
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return _utf8(data[:e.start]) + "\ufffd" + _utf8(data[e.start + 1:])


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that text can become (id, score), the ids of the bytes, the piece of every id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    names: tuple[str, ...]


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = range(model.get_piece_size())
    names = tuple(model.id_to_piece(i) for i in size)
    byte_ids = {int(names[i][1:-1], 16): i for i in size if model.is_byte(i)}
    probe = " ﬁ  ÅΩ "
    if len(byte_ids) != 256 or model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model needs byte fallback, a dummy prefix and no normalisation")
    plain = {names[i]: (i, model.get_score(i)) for i in size
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                     or model.is_unused(i))}
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in plain):
        raise ValueError("a piece has a space after another character")
    return Vocabulary(plain, tuple(byte_ids[b] for b in range(256)), names)


def merge(text: str, vocabulary: Vocabulary) -> list[str]:
    """The definition: join the neighbours with the best score, leftmost first, to the end."""
    parts, get, none = list(text), vocabulary.pieces.get, (-1, -float("inf"))
    scores = [get(a + b, none)[1] for a, b in zip(parts, parts[1:])]
    while scores:
        best = max(scores)
        if best == none[1]:
            break
        i = scores.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i:
            scores[i - 1] = get(parts[i - 1] + parts[i], none)[1]
        if i < len(scores):
            scores[i] = get(parts[i] + parts[i + 1], none)[1]
    return parts


class Automaton:
    """Aho-Corasick over the pieces: after each letter of a text, all pieces that end there.

    ``ends`` has those of every state, longest first, as (length, number, verdicts on the pairs with
    a token before). ``steps`` has the trie's edges and, as they are met, the steps over its fails.
    """

    def __init__(self, pieces: dict[str, int]):
        self.steps: list[dict[str, int]] = [{}]
        self.pairs: list[dict[int, bool]] = []
        own: dict[int, tuple[int, int, dict[int, bool]]] = {}
        for piece, number in pieces.items():
            state = 0
            for letter in piece:
                if letter not in self.steps[state]:
                    self.steps[state][letter] = len(self.steps)
                    self.steps.append({})
                state = self.steps[state][letter]
            self.pairs.append({})
            own[state] = len(piece), number, self.pairs[-1]
        self.fails = [0] * len(self.steps)
        self.ends: list[tuple] = [()] * len(self.steps)
        self.n_steps = 0
        level = [0]
        while level:
            below = []
            for state in level:
                for letter, child in list(self.steps[state].items()):
                    fail = self._over(self.fails[state], letter) if state else 0
                    self.fails[child] = fail
                    self.ends[child] = ((own[child],) if child in own else ()) + self.ends[fail]
                    below.append(child)
            level = below

    def _over(self, state: int, letter: str) -> int:
        while state and letter not in self.steps[state]:
            state = self.fails[state]
        return self.steps[state].get(letter, 0)

    def step(self, state: int, letter: str) -> int:
        """A step that ``steps`` doesn't have."""
        following = self._over(state, letter)
        if self.n_steps < REMEMBERED_STEPS:
            self.n_steps += 1
            self.steps[state][letter] = following
        return following


class Codec:
    """Encodes and decodes whole texts; remembers pairs of tokens and the ids of short cuts.

    Cuts are written with spaces, which take a byte a letter in most texts, pieces with U+2581.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = Automaton({p: number for p, (number, _) in vocabulary.pieces.items()})
        self.lengths = [len(name) for name in vocabulary.names]
        self.letters = {p.replace(SPACE, " ") for p in vocabulary.pieces if len(p) == 1}
        self.n_pairs = 0
        # Cuts of the newer and the older generation; the older one goes when the newer is full.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tables: dict[str, tuple[list[int], int]] = {}
        self.cuts = re.compile("\n| *[^ \n]+| +" if "\n" not in vocabulary.pieces
                               else " *[^ ]+| +")

    def _holds(self, before: int, token: int, known: dict[int, bool]) -> bool:
        """Whether the two tokens stay apart and whole; before is -1 at the start of a cut."""
        names = self.vocabulary.names
        pair = [names[token]] if before < 0 else [names[before], names[token]]
        if self.n_pairs >= REMEMBERED_PAIRS:
            for pairs in self.automaton.pairs:
                pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        whole = "".join(pair)
        # Two tokens that make a piece would be merged in the end.
        known[before] = holds = not (len(pair) > 1 and whole in self.vocabulary.pieces) and merge(
            whole, self.vocabulary) == pair
        return holds

    def last_tokens(self, text: str) -> list[int]:
        """The prefix table: for each prefix of known characters the last token of its encoding."""
        return self._table_of(text)[0]

    def _table_of(self, text: str) -> tuple[list[int], int]:
        """The prefix table, and the automaton's state after the text.

        A text's table begins with that of its beginning, which many short ones share."""
        size, state = len(text), 0
        start = (size - 1) // STRIDE * STRIDE if size <= SHORT else 0
        if start > 0:
            beginning = text[:start]
            found = self.tables.get(beginning)
            if found is None:
                found = self._table_of(beginning)
                if len(self.tables) >= REMEMBERED_TABLES:
                    self.tables.clear()
                self.tables[beginning] = found
            last, state = found
            last = last + [-1] * (size - start)
        else:
            start, last = 0, [-1] * (size + 1)
        steps, ends = self.automaton.steps, self.automaton.ends
        for end, letter in enumerate(text[start:], start + 1):
            following = steps[state].get(letter)
            state = self.automaton.step(state, letter) if following is None else following
            for length, token, known in ends[state]:
                before = last[end - length]
                holds = known.get(before)
                if holds or holds is None and self._holds(before, token, known):
                    last[end] = token
                    break
        return last, state

    def _known(self, cut: str) -> list[int]:
        text = cut.replace(" ", SPACE)
        last, lengths, ids, end = self.last_tokens(text), self.lengths, [], len(text)
        while end:
            token = last[end]
            ids.append(token)
            end -= lengths[token]
        ids.reverse()
        return ids

    def _encode_cut(self, cut: str) -> bytes:
        if self.letters.issuperset(cut):
            return array("i", self._known(cut)).tobytes()
        ids, start = array("i"), 0
        for i, letter in enumerate(cut):
            if letter not in self.letters:
                if start < i:
                    ids.extend(self._known(cut[start:i]))
                symbol = letter.replace(" ", SPACE)
                ids.extend(self.vocabulary.byte_ids[b] for b in symbol.encode())
                start = i + 1
        if start < len(cut):
            ids.extend(self._known(cut[start:]))
        return ids.tobytes()

    def _ids_of(self, cut: str) -> bytes:
        """Ids of a cut that is not in the newer generation, as bytes of 32-bit integers."""
        ids = self.old.get(cut) or self._encode_cut(cut)
        if len(cut) <= SHORT:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            self.new[cut] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        cuts = self.cuts.findall(" " + text.replace(SPACE, " "))
        known = self.new
        ids = [known.get(c) or self._ids_of(c) for c in cuts]
        return np.frombuffer(b"".join(ids), dtype=np.int32)

    @cached_property
    def _texts(self) -> list[str]:
        """What each id stands for; bytes over 127 stand for nothing on their own."""
        texts = [name.replace(SPACE, " ") for name in self.vocabulary.names]
        for byte, number in enumerate(self.vocabulary.byte_ids):
            texts[number] = chr(byte) if byte < 128 else ""
        return texts

    @cached_property
    def _high(self) -> np.ndarray:
        """The byte over 127 that an id stands for, 0 if none."""
        high = np.zeros(len(self.vocabulary.names), dtype=np.uint8)
        high[list(self.vocabulary.byte_ids[128:])] = np.arange(128, 256)
        return high

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, the dummy space removed; runs of bytes that are no UTF-8 give U+FFFD."""
        texts = self._texts
        parts = [texts[i] for i in ids.tolist()]
        high = self._high[ids]
        if high.any():
            at = np.flatnonzero(high)
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                parts[run[0]] = _utf8(high[run].tobytes())
        text = "".join(parts)
        return text[1:] if parts and self.vocabulary.names[ids[0]][0] == SPACE else text


    @cached_property
    def _table(self) -> pa.Array:
        """The bytes that each id stands for, and then those of each id at the start of a text."""
        whole = [bytes([high]) if high else text.encode()
                 for text, high in zip(self._texts, self._high.tolist())]
        first = [w[1:] if name[0] == SPACE else w
                 for w, name in zip(whole, self.vocabulary.names)]
        return pa.array(whole + first, pa.binary())

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """What the ids of each text decode to; text i has those from ends[i] to ends[i + 1]."""
        starts, which = ends[:-1][ends[1:] > ends[:-1]], ids.astype(np.int32)
        which[starts] += len(self.vocabulary.names)
        parts = self._table.take(pa.array(which))
        _, at, data = parts.buffers()
        at = np.frombuffer(at, dtype=np.int32, count=len(ids) + 1) if len(ids) else np.zeros(1, int)
        texts = pa.StringArray.from_buffers(
            len(ends) - 1, pa.py_buffer(at[ends].astype(np.int32)), data or pa.py_buffer(b""))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no UTF-8, which encoding a text never gives
            return pa.array([self.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])],
                            pa.string())
        return texts


#: The codec of this worker process, by the key of its vocabulary.
_CODECS: dict[str, Codec] = {}


def _codec(key: str, vocabulary) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary.value)
    return _CODECS[key]


def encode_and_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every whole text, and what they decode to."""
    key, vocabulary = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(
        read_vocabulary(model_path))

    def run(part):
        codec = _codec(key, vocabulary)
        ids = [codec.encode(t) for t in part.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        ids = np.concatenate([np.empty(0, np.int32), *ids])
        return [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                codec.decode_all(ids, ends)]

    return map_texts(docs.select("doc_id", "text"),
                     f"doc_id {type_of(docs, 'doc_id')}, ids array<int>, decoded string", run)
