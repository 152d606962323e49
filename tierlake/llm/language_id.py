"""Language identification by a string kernel.

The kernel of two texts is the number of character n-grams, of one to three characters, that are
present in both, divided by the geometric mean of how many each has: a blended-spectrum presence
kernel. Its features live on a fixed alphabet (the most frequent characters of the learning
texts; all others are one character), in lower case with every run of other than letters as one
space. Landmarks, equally many of each language, give a Nystroem map
``phi(x) = K(x, landmarks) K(landmarks, landmarks)^-1/2``; on it, one kernel ridge regression a
language is fitted one-versus-rest.

As the kernel is a product of presence vectors, the regressions' values for a batch of texts are
``(P L') A = P (L' A)``: P the presence matrix of the batch (a row a passage), L that of the landmarks, A the dual
coefficients. ``L' A`` is computed once, so a batch costs one product with a column a language.
Presence is counted over the n-grams that occur in a landmark; a text's own norm is taken over
them too.

A text is read as passages of about PASSAGE characters, and its values are the mean of theirs by
length: presence forgets how often an n-gram occurs, so a few quoted lines of another language
would weigh as much as the pages around them.

Learning reads at most ``per_language`` documents of each language (by a hash of the id; ids that
may be learned from, non-null lang) and ``landmarks`` of these as landmarks: bounded by the
number of languages. Every text is scored as a whole.

Defined results: texts that are null or have no letter get ``und`` and score 0; a text without
any known n-gram gets the most frequent language's value of the empty vector; without learning
rows every text is ``und``. The score is the softmax share of the language chosen, ties go to the
smaller name. Null ids are scored and not learned from; repeated rows get the same result; other
columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierlake.llm.common import is_held_out, map_texts, may_learn, type_of

UNDETERMINED = "und"
#: Word characters of ``re`` that are no letters (category L) and no decimal digits: ½, ², Ⅷ, ③.
_NUMBERS = frozenset(c for c in map(chr, range(sys.maxunicode + 1))
                     if c.isalnum() and not c.isalpha() and not c.isdecimal())
_NO_LETTERS = re.compile(r"[\W\d_]+")
#: Values of the regressions lie around -1 and 1; the softmax is taken of this multiple.
SHARPNESS = 4.0
#: Characters of a passage, about.
PASSAGE = 600
SALTS = 8


def normal(text: str | None) -> str:
    """Lower case, runs of other than letters as one space; empty if there is no letter."""
    text = (text or "").lower()
    if not text.isascii() and (numbers := _NUMBERS.intersection(text)):
        text = text.translate(dict.fromkeys(map(ord, numbers), " "))
    words = _NO_LETTERS.sub(" ", text).strip()
    return f" {words} " if words else ""


def passages(text: str) -> list[str]:
    """A normal text cut at spaces into nearly equal parts; no parts of an empty one."""
    count = max(1, round(len(text) / PASSAGE))
    ends = [0, *(text.find(" ", len(text) * i // count) for i in range(1, count)), len(text)]
    ends = sorted({e for e in ends if e >= 0})
    return [text[a:b] + " " for a, b in zip(ends, ends[1:])]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@dataclass
class Spectrum:
    """The alphabet, and the column of every n-gram of the landmarks (-1: none)."""

    size: int
    letters: np.ndarray
    columns: list[np.ndarray]
    width: int

    def grams(self, text: str) -> list[np.ndarray]:
        """Numbers of the text's 1-, 2- and 3-grams, in their order and with repeats."""
        codes = _codes(text)
        one = self.letters[np.minimum(codes, len(self.letters) - 1)].astype(np.int64)
        two = one[:-1] * self.size + one[1:]
        return [one, two, two[:-1] * self.size + one[2:]]

    def presence(self, texts: list[str]) -> np.ndarray:
        """A row a text, 1 where one of its n-grams is, divided by the row's norm."""
        out = np.zeros((len(texts), self.width + 1), dtype=np.float32)
        for row, text in zip(out, texts):
            for columns, numbers in zip(self.columns, self.grams(text)):
                row[columns[numbers]] = 1  # unknown n-grams fall on the last column
        out = out[:, :-1]
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


def spectrum_of(texts: list[str], landmarks: list[str], alphabet: int) -> Spectrum:
    counts: Counter = Counter()
    for text in texts:
        counts.update(text)
    chosen = sorted(counts, key=lambda c: (-counts[c], c))[:alphabet]
    letters = np.zeros(max(map(ord, chosen), default=0) + 2, dtype=np.int32)
    for number, letter in enumerate(chosen):
        letters[ord(letter)] = number + 1
    letters[-1] = 0
    made = Spectrum(len(chosen) + 1, letters, [], 0)
    width = 0
    for n in range(3):
        present = np.unique(np.concatenate([made.grams(t)[n] for t in landmarks]))
        columns = np.full(made.size ** (n + 1), -1, dtype=np.int32)
        columns[present] = np.arange(width, width + len(present))
        made.columns.append(columns)
        width += len(present)
    made.width = width
    return made


@dataclass
class Model:
    spectrum: Spectrum | None
    languages: list[str]
    weights: np.ndarray | None  # n-gram columns x languages, last row the intercepts

    def values(self, texts: list[str]) -> np.ndarray:
        return self.spectrum.presence(texts) @ self.weights[:-1] + self.weights[-1]

    def of_text(self, text: str, batch: int = 256) -> np.ndarray:
        """The mean of a text's passages, by their lengths."""
        parts = passages(text)
        lengths = np.array([len(p) for p in parts], dtype=float)
        values = np.concatenate([self.values(parts[i:i + batch])
                                 for i in range(0, len(parts), batch)]).astype(float)
        return lengths @ values / lengths.sum()


def fit(docs: DataFrame, per_language: int = 600, landmarks: int = 48, alphabet: int = 80,
        ridge: float = 0.1) -> Model:
    """Learn from bounded samples; see the module."""
    order = F.xxhash64("doc_id"), "doc_id"
    salt = F.pmod(F.hash("doc_id"), F.lit(SALTS))
    # Each salt of a language brings its first ids, so that a frequent language is no one task's.
    ids = (docs.filter(may_learn() & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order)))
           .filter(F.col("rank") <= per_language)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
           .filter(F.col("rank") <= per_language))
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .select("lang", "rank", "text").orderBy("lang", "rank", "text").toArrow())
    samples = [(part, lang, i) for t, lang in zip(*(
        rows.column(c).to_pylist() for c in ("text", "lang")))
        for i, part in enumerate(passages(normal(t)))]
    # The first passages of all documents come before the second ones: landmarks differ more.
    samples.sort(key=lambda s: s[2])
    languages = sorted({lang for _, lang, _ in samples})
    if not languages:
        return Model(None, [], None)
    marks = [t for lang in languages for t in [s[0] for s in samples if s[1] == lang][:landmarks]]
    texts = [t for t, _, _ in samples]
    spectrum = spectrum_of(texts, marks, alphabet)
    at_marks = spectrum.presence(marks)
    values, vectors = np.linalg.eigh((at_marks @ at_marks.T).astype(float))
    kept = values > 1e-6 * values[-1]
    root = vectors[:, kept] / np.sqrt(values[kept])  # K_mm^-1/2 on its own range
    phi = np.concatenate([spectrum.presence(texts[i:i + 256]) @ at_marks.T
                          for i in range(0, len(texts), 256)]).astype(float) @ root
    targets = np.array([[1.0 if lang == x else -1.0 for x in languages] for _, lang, _ in samples])
    # Every language weighs the same, however many samples it has.
    weight = np.array([1 / sum(s[1] == lang for s in samples) for lang in languages])
    weight = np.array([weight[languages.index(lang)] for _, lang, _ in samples])
    weight *= len(samples) / weight.sum()
    middle, offset = np.average(phi, axis=0, weights=weight), np.average(
        targets, axis=0, weights=weight)
    centred = phi - middle
    dual = np.linalg.solve((centred * weight[:, None]).T @ centred + ridge * np.eye(phi.shape[1]),
                           (centred * weight[:, None]).T @ (targets - offset))
    weights = np.vstack([at_marks.T @ (root @ dual), offset - middle @ dual])
    return Model(spectrum, languages, weights.astype(np.float32))


def predict(docs: DataFrame, model: Model, batch: int = 128) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text."""
    def run(part):
        texts = [normal(t) for t in part.column("text").to_pylist()]
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        with_letters = [i for i, t in enumerate(texts) if t and model.languages]
        for start in range(0, len(with_letters), batch):
            rows = with_letters[start:start + batch]
            values = np.stack([model.of_text(texts[i]) for i in rows])
            best = values.argmax(axis=1)
            odds = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
            scores[rows] = 1 / odds.sum(axis=1)
            for i, k in zip(rows, best):
                names[i] = model.languages[k]
        return [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()),
                pa.array(scores)]

    return map_texts(docs.select("doc_id", "text", is_held_out().alias("held_out")),
                     f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, lang_pred string, "
                     "score double", run)
