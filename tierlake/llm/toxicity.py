"""Toxicity by a weighted finite-state pattern grammar.

Words become tags (insult, threat verb, self, intent, target, negation, report); clauses are runs
of tags. Five small machines read a clause tag by tag: negation and reported speech keep a scope
open, target keeps a distance, threat follows "self, intent, verb, target", and insult reacts to
its tag. ``compose`` joins them to one machine over the product of their states, whose output for
each clause is a multiset of symbols such as ``insult+aimed`` or ``insult+negated``. A document's
score is a logistic function of the weighted symbols, so an isolated word counts by the clause it
stands in.

Insults are learned: whole words, and stems for inflected forms, that stand in toxic documents
nearly only, often enough not to be chance, and after different words (text that is merely copied
has always the same). The symbols' weights are fitted from the same labels, starting from the
prior below.

Labels: documents whose id may be learned from (``common.may_learn``), at most ``max_train`` of
them, taken by a hash of the id. This bounds what the fit reads and what reaches the driver (one
row of counts a document, ``max_terms`` terms). Scoring covers all texts as a whole.

Defined results: null or empty texts have no clause and get the score of the bias alone; without
any usable label the built-in lexicon and prior weights are used. Every row gets a result;
equal rows give equal results, a null id is scored like any other and never
learned from. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import (
    in_batches, is_held_out, map_texts, may_learn, slices, type_of)

# The built-in lexicon. Insults are only a start; the labels bring their own.
INSULTS = ("idiot idiots moron morons stupid dumb scum trash loser losers pathetic worthless "
           "disgusting imbecile cretin clown vermin filth").split()
VERBS = "kill hurt destroy murder beat shoot stab hang burn strangle".split()
SELF = "i we i'll we'll i'm".split()
INTENT = "will shall gonna going must should i'll we'll".split()
TARGETS = ("you your you're u he she they them him her his their yourself du dich dein ihr sie "
           "tu toi vous ton vosotros usted te").split()
NEGATIONS = ("not never nobody isn't aren't wasn't don't doesn't didn't nicht kein keine nie "
             "pas jamais nunca jamás tampoco").split()
REPORTS = ("said says called calls wrote claimed claims alleged quoted reported sagte nannte "
           "schrieb disait appelait dijo llamó escribió").split()

OTHER, INSULT, VERB, SELF_TAG, INTENT_TAG, TARGET, NEGATION, REPORT = range(8)
TAGS = 8
#: Symbols of the composed machine, and the prior mean of their weights.
SYMBOLS = {"insult": 3.0, "insult+aimed": 4.0, "insult+negated": 0.5, "insult+reported": 1.0,
           "threat": 5.0, "threat+negated": 0.5, "threat+reported": 1.0}
ORDER = tuple(SYMBOLS)
BIAS = -4.0
_PIECES = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:\n]+")
PREFIXES = range(3, 9)
#: Chance level for a term: expected number of false terms among so many tried.
FALSE_TERMS, TRIED = 0.01, 1e7


# ---- machines: start state and step(state, tag) -> (state, mark or None) -------------------

def negation(state, tag):
    """Open for the three words after a negation."""
    if tag == NEGATION:
        return 3, None
    return max(state - 1, 0), "negated" if state else None


def report(state, tag):
    """Open until the end of the clause."""
    return int(state or tag == REPORT), "reported" if state else None


def target(state, tag):
    """Open for the four words after a target."""
    if tag == TARGET:
        return 4, None
    return max(state - 1, 0), "aimed" if state else None


def insult(state, tag):
    return 0, "insult" if tag == INSULT else None


def threat(state, tag):
    """self, intent, verb, target, each at most three words after the one before.

    States are (step, words left); "kill yourself" style orders need the verb and target only
    when the verb opens the clause (step 2 is the start).
    """
    step, left = divmod(state, 4)
    wanted = {0: (SELF_TAG,), 1: (INTENT_TAG,), 2: (VERB,), 3: (TARGET,)}[step]
    if tag in wanted:
        return (0, "threat") if step == 3 else ((step + 1) * 4 + 3, None)
    if tag == SELF_TAG:
        return 1 * 4 + 3, None
    return (state - 1 if step and left else 0), None


MACHINES = ((negation, 0), (report, 0), (target, 0), (insult, 0), (threat, 2 * 4))


def compose(machines):
    """The product machine: all reachable states, with next state and symbol for every tag.

    Returns (next, symbol) as nested lists; state 0 is the start.
    """
    start = tuple(s for _, s in machines)
    number, todo, nexts, symbols = {start: 0}, [start], [], []
    while todo:
        state = todo.pop(0)
        row, out = [], []
        for tag in range(TAGS):
            moved, marks = [], set()
            for (step, _), s in zip(machines, state):
                after, mark = step(s, tag)
                moved.append(after)
                marks.add(mark)
            moved = tuple(moved)
            if moved not in number:
                number[moved] = len(number)
                todo.append(moved)
            row.append(number[moved])
            out.append(_symbol(marks))
        nexts.append(row)
        symbols.append(out)
    return nexts, symbols


def _symbol(marks: set) -> int:
    """The output symbol of a step, -1 for none. A threat includes its target already."""
    kind = "threat" if "threat" in marks else "insult" if "insult" in marks else None
    if kind is None:
        return -1
    how = next((m for m in ("negated", "reported", "aimed") if m in marks), None)
    return ORDER.index(kind if how is None or f"{kind}+{how}" not in SYMBOLS else f"{kind}+{how}")


NEXT, SYMBOL = compose(MACHINES)


# ---- lexicon and model ----------------------------------------------------------------------

def _base_tags() -> dict[str, int]:
    pairs = ((INSULTS, INSULT), (VERBS, VERB), (INTENT, INTENT_TAG), (SELF, SELF_TAG),
             (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
    return {word: tag for words, tag in pairs for word in words}


@dataclass
class Model:
    """Learned insults, stems, and one weight for each symbol after the bias."""

    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    weights: tuple[float, ...] = (BIAS, *SYMBOLS.values())

    def tagger(self) -> Tagger:
        return Tagger(self)


class Tagger(dict):
    """word -> tag, filled as words come; emptied before it grows large."""

    def __init__(self, model: Model):
        super().__init__()
        self.fixed = _base_tags() | {w: INSULT for w in model.words}
        self.stems = model.stems
        self.lengths = sorted({len(s) for s in model.stems})

    def __missing__(self, word: str) -> int:
        tag = self.fixed.get(word.replace("’", "'"), OTHER)
        if tag == OTHER and any(word[:n] in self.stems for n in self.lengths):
            tag = INSULT
        if word[0] in ".!?;:\n":
            tag = -1
        if len(self) > 200_000:
            self.clear()
        self[word] = tag
        return tag


def symbols_of(text: str | None, tagger: Tagger) -> Counter:
    """Output symbols of all clauses of a text; clauses end at . ! ? ; : and line ends."""
    tags = [tagger[w] for w in _PIECES.findall((text or "").lower())]
    counts: Counter = Counter()
    if INSULT not in tags and VERB not in tags:
        return counts
    state = 0
    for tag in tags:
        if tag < 0:
            state = 0
            continue
        symbol = SYMBOL[state][tag]
        if symbol >= 0:
            counts[symbol] += 1
        state = NEXT[state][tag]
    return counts


def _features(texts, tagger) -> np.ndarray:
    """A row a text: 1 for the bias, then log(1 + count) of each symbol."""
    out = np.zeros((len(texts), 1 + len(ORDER)))
    out[:, 0] = 1
    for row, text in enumerate(texts):
        for symbol, n in symbols_of(text, tagger).items():
            out[row, 1 + symbol] = math.log1p(n)
    return out


# ---- learning -------------------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(doc_id, text, toxic) of at most max_train labelled ids that may be learned from.

    Conflicting labels of an id count as toxic. The ids are bounded, hence broadcast.
    """
    ids = (labels.filter(may_learn() & F.col("toxic").isNotNull()).groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def _count_terms(part: pa.RecordBatch) -> list[pa.Array]:
    """Whole words ("w ") and prefixes of a slice's texts: documents by label, words before."""
    found: dict[str, list[int]] = {}
    for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
        words = [w for w in _PIECES.findall((text or "").lower()) if w[0] not in ".!?;:\n"]
        seen: set[str] = set()
        for before, word in zip(["", *words], words):
            if not toxic and word + " " in seen:
                continue
            bit = 1 << crc32(before.encode()) % 61 if toxic else 0
            for term in (word + " ", *(word[:n] for n in PREFIXES if n < len(word))):
                row = found.setdefault(term, [0, 0, 0])
                row[2] |= bit
                if term not in seen:
                    seen.add(term)
                    row[0 if toxic else 1] += 1
    columns = list(zip(*found.values())) or [(), (), ()]
    return [pa.array(list(found), pa.string()), *(pa.array(c, pa.int64()) for c in columns)]


def learn_lexicon(rows: DataFrame, positives: int, total: int,
                  max_terms: int) -> tuple[frozenset[str], frozenset[str]]:
    """Whole words and stems found in toxic documents nearly only.

    A term needs so many toxic documents that chance would bring FALSE_TERMS among TRIED terms,
    nine tenths of its documents toxic, and at least three (or half as many as documents, up to
    twelve) different words before it. A stem must have several forms: neither one longer prefix
    nor one whole word may account for it.
    """
    if not 0 < positives < total:
        return frozenset(), frozenset()
    rate = min(positives / total, 0.5)
    support = max(3, math.ceil(math.log(FALSE_TERMS / TRIED) / math.log(rate)))
    terms = (map_texts(rows, "term string, pos bigint, neg bigint, before bigint", _count_terms)
             .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                  F.bit_count(F.bit_or("before")).alias("before"))
             .filter((F.col("pos") >= support) & (F.col("pos") >= 9 * F.col("neg"))
                     & (F.col("before") >= F.least(F.lit(12), F.greatest(
                         F.lit(3), F.col("pos") / 2))))
             .orderBy(F.desc("pos"), "term").limit(max_terms).collect())
    pos = {r["term"]: r["pos"] for r in terms}
    words = {t[:-1] for t in pos if t.endswith(" ")}
    stems: set[str] = set()
    for stem in sorted((t for t in pos if not t.endswith(" ")), key=lambda t: (len(t), t)):
        longer = [t for t in pos if t != stem and t.startswith(stem)]
        alone = any(pos[t] >= 0.95 * pos[stem] for t in longer if not t.endswith(" "))
        whole = any(pos[t] >= 0.8 * pos[stem] for t in longer if t.endswith(" "))
        covered = any(stem[:n] in stems for n in PREFIXES if n < len(stem))
        if not (alone or whole or covered):
            stems.add(stem)
    return frozenset(words), frozenset(stems)


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression, drawn to the prior weights with precision 1/4: Newton steps of a
    length of one at most, which do not overshoot."""
    prior = np.array([BIAS, *SYMBOLS.values()])
    w = prior.copy()
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - 0.25 * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.25 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step).max())
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000,
        max_terms: int = 4_000) -> Model:
    """Learn lexicon and weights; see the module for the bounds."""
    rows = training_rows(docs, labels, max_train)
    classes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    total, positives = sum(classes.values()), sum(n for t, n in classes.items() if t)
    if not 0 < positives < total:
        return Model()
    words, stems = learn_lexicon(rows, positives, total, max_terms)
    model = Model(words, stems)

    def features(part):
        x = _features(part.column("text").to_pylist(), model.tagger())
        return [part.column("toxic"), *(pa.array(x[:, i]) for i in range(x.shape[1]))]

    columns = ", ".join(f"x{i} double" for i in range(1 + len(ORDER)))
    seen = map_texts(rows, f"toxic int, {columns}", features).toArrow()
    x = np.stack([seen.column(f"x{i}").to_numpy() for i in range(1 + len(ORDER))], axis=1)
    return Model(words, stems, _fit(x, (seen.column("toxic").to_numpy() > 0).astype(float)))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_insults, n_threats) of every text."""
    weights = np.array(model.weights)
    insults = [1 + i for i, s in enumerate(ORDER) if s.startswith("insult")]
    taggers: list[Tagger] = []

    def run(part):
        if not taggers:
            taggers.append(model.tagger())
        x = _features(part.column("text").to_pylist(), taggers[0])
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        n = np.rint(np.expm1(x[:, 1:])).astype("int64")
        hits = n[:, [i - 1 for i in insults]].sum(axis=1)
        return [part.column("doc_id"), part.column("held_out"), pa.array(p),
                pa.array((p >= threshold).astype("int32")), pa.array(hits),
                pa.array(n.sum(axis=1) - hits)]

    return map_texts(docs.select("doc_id", "text", is_held_out().alias("held_out")),
                     f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, score double, "
                     "predicted int, n_insults bigint, n_threats bigint", run)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents, all columns, whose text the fitted grammar doesn't call toxic.

    The verdict is taken in one pass over the rows themselves, so repeated and null ids are safe.
    """
    model = fit(docs, labels)
    weights = np.array(model.weights)
    taggers: list[Tagger] = []

    def keep(batches):
        for batch in slices(batches, "text"):
            if not taggers:
                taggers.append(model.tagger())
            x = _features(batch.column("text").to_pylist(), taggers[0])
            yield batch.filter(pa.array(x @ weights < math.log(threshold / (1 - threshold))))

    return in_batches(docs, keep, docs.schema)
