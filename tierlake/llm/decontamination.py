"""Benchmark decontamination by a BM25 index of test items, searched with block-max WAND.

Test items are cut into segments of at most SEGMENT words, which are indexed. Every training text
is read in passages of PASSAGE words that overlap by more than a segment, so each segment-long
stretch of a text lies in some passage whole. A passage is a query (a set of words); a segment is
retrieved if its BM25 score is at least ``share`` of the most it can score, that is of the score
of its own words. Impacts are stored divided by that maximum, so one threshold holds for all.

Postings are in order of segments and cut into blocks. The sum of the passage's block maxima
bounds all segments of a block; passages in which no block can reach the threshold (nearly all)
end there. For the others WAND moves one cursor a word: cursors are sorted by segment, the pivot
is where list maxima reach the threshold, block maxima decide whether to score it or to skip past
the block. All segments over the threshold are retrieved, none is cut off.

A retrieved item is verified against the words around the passage: ``overlap`` of the question's
and of the answer's shingles (SHINGLE words) must be there. An item without columns of its own
for them is split at its last sentence; one that has a single sentence, at three quarters.

The index is broadcast in shards of at most ``shard`` items by a hash of the item id, each bounded
by that; statistics (document frequencies, mean length) are those of all items, taken in Spark.
The training texts are read once a shard.

Defined results: null or empty texts contain nothing; items that are null or without words are
never found; repeated items and texts give a row each, and equal (doc_id, item_id) rows are kept
once; a null doc_id is kept as it is. An item of a few words is one shingle. An empty benchmark
leaves all. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import in_batches, map_texts, slices, type_of

SEGMENT, PASSAGE, STRIDE, SHINGLE = 48, 192, 128, 5
K1, B = 1.2, 0.75
#: Blocks are of two segments, or longer so that block maxima have at most so many cells.
CELLS = 16_000_000
WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]+\s+(?=\S)")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def segments_of(text: str | None) -> list[list[str]]:
    """Nearly equal runs of at most SEGMENT words."""
    words = words_of(text)
    n = math.ceil(len(words) / SEGMENT)
    return [words[i * len(words) // n:(i + 1) * len(words) // n] for i in range(n)]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if ends and words_of(text[:ends[-1]]) and words_of(text[ends[-1]:]):
        return words_of(text[:ends[-1]]), words_of(text[ends[-1]:])
    words = words_of(text)
    cut = max(1, len(words) * 3 // 4)
    return words[:cut], words[cut:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def contained(part: list[str], words: list[str]) -> float:
    """Share of the part's shingles among the words; 1 for an empty part."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    size = min(SHINGLE, len(part))
    there = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
    return len(wanted & there) / len(wanted)


@dataclass
class Index:
    """Postings of a shard's segments, ordered by segment, with list and block maxima."""

    items: list[tuple]  # (item id, question, answer)
    owner: list[int]  # segment -> item
    terms: dict[str, int]
    postings: list[tuple[np.ndarray, np.ndarray]]  # term -> segments, impacts
    list_max: np.ndarray
    block_max: np.ndarray  # terms x blocks
    block_size: int


def build_index(items: list[tuple], frequency: dict[str, int], n: int, mean: float) -> Index:
    """items: (id, text); frequency: segments with a word, of n in all items."""
    kept, owner, postings, terms = [], [], {}, {}
    for number, text in items:
        segments = segments_of(text)
        if segments:
            kept.append((number, *question_and_answer(text)))
        for words in segments:
            counts = Counter(words)
            norm = K1 * (1 - B + B * len(words) / mean)
            impact = {w: math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5))
                      * c * (K1 + 1) / (c + norm) for w, c in counts.items()}
            most = sum(impact.values())
            for word, value in impact.items():
                postings.setdefault(terms.setdefault(word, len(terms)), []).append(
                    (len(owner), value / most))
            owner.append(len(kept) - 1)
    size = max(2, math.ceil(len(owner) * len(terms) / CELLS))
    block_max = np.zeros((len(terms), max(1, math.ceil(len(owner) / size))), dtype=np.float32)
    lists = []
    for term in range(len(terms)):
        segments, impacts = (np.array(x) for x in zip(*postings[term]))
        lists.append((segments, impacts))
        np.maximum.at(block_max[term], segments // size, impacts.astype(np.float32))
    # Rounding to float32 must not make a bound smaller than what it bounds.
    block_max *= np.float32(1 + 1e-6)
    most = block_max.max(axis=1) if len(terms) else np.zeros(0, dtype=np.float32)
    return Index(kept, owner, terms, lists, most, block_max, size)


def block_max_wand(index: Index, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All (segment, score) with a score of at least the threshold. query: distinct terms."""
    cursors = [[int(index.postings[t][0][0]), 0, int(t)] for t in query]  # segment, place, term
    found = []
    slack = threshold - 1e-9

    def move(cursor: list, segment: int) -> bool:
        """To the first posting at or after the segment; false at the end of the list."""
        segments = index.postings[cursor[2]][0]
        cursor[1] = int(np.searchsorted(segments, segment))
        if cursor[1] == len(segments):
            return False
        cursor[0] = int(segments[cursor[1]])
        return True

    while cursors:
        cursors.sort()
        bound, pivot = 0.0, None
        for place, (_, _, term) in enumerate(cursors):
            bound += index.list_max[term]
            if bound >= slack:
                pivot = place
                break
        if pivot is None:
            return found
        segment = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
            pivot += 1
        block = segment // index.block_size
        if sum(index.block_max[c[2], block] for c in cursors[:pivot + 1]) < slack:
            # No segment of this block can hold before the next cursor comes in.
            target = (block + 1) * index.block_size
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            moving = cursors[:pivot + 1]
        elif cursors[0][0] == segment:
            score = sum(index.postings[t][1][place] for _, place, t in cursors[:pivot + 1])
            if score >= slack:
                found.append((segment, float(score)))
            target, moving = segment + 1, cursors[:pivot + 1]
        else:
            target, moving = segment, [c for c in cursors[:pivot + 1] if c[0] < segment]
        ended = [c for c in moving if not move(c, max(target, c[0]))]
        if ended:
            cursors = [c for c in cursors if not any(c is e for e in ended)]
    return found


def leaks_in(text: str | None, index: Index, share: float,
             overlap: float) -> list[tuple[int, float, float, float]]:
    """(item, best share of BM25, question overlap, answer overlap) of the items in a text."""
    words = words_of(text)
    number = index.terms.get
    terms = np.array([number(w, -1) for w in words], dtype=np.int64)
    if not index.owner or not (terms >= 0).any():
        return []
    best: dict[int, tuple[float, float, float]] = {}
    for start in range(0, max(1, len(words) - (PASSAGE - STRIDE)), STRIDE):
        query = np.unique(terms[start:start + PASSAGE])
        query = query[1:] if len(query) and query[0] < 0 else query
        if index.block_max[query].sum(axis=0).max(initial=0) < share - 1e-6:
            continue
        for segment, score in block_max_wand(index, query, share):
            item = index.owner[segment]
            _, question, answer = index.items[item]
            if best.get(item, (0,))[0] >= score:
                continue
            around = len(question) + len(answer)
            near = words[max(0, start - around):start + PASSAGE + around]
            shares = contained(question, near), contained(answer, near)
            if min(shares) >= overlap:
                best[item] = (score, *shares)
    return [(item, *values) for item, values in sorted(best.items())]


def indexes(benchmark: DataFrame, shard: int = 5_000):
    """The index of each shard, one after the other."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()

    def terms(part):
        found, lengths = Counter(), Counter()
        for text in part.column("text").to_pylist():
            for words in segments_of(text):
                found.update(set(words))
                lengths.update({"n": 1, "words": len(words)})
        # Totals go along as terms that no word can be.
        found.update({" n": lengths["n"], " words": lengths["words"]})
        return [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]

    def words(part):
        return [pa.array(list({w for text in part.column("text").to_pylist()
                               for words in segments_of(text) for w in words}), pa.string())]

    counts = map_texts(items, "term string, n bigint", terms).groupBy("term").agg(
        F.sum("n").alias("n"))
    totals = {r["term"]: r["n"] for r in counts.filter(F.col("term").startswith(" ")).collect()}
    n, total = totals.get(" n", 0), totals.get(" words", 0)
    shards = math.ceil(items.count() / shard)
    for number in range(shards if n else 0):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == number)
        texts = [tuple(r) for r in part.orderBy("item_id", "text").collect()]
        if shards == 1:
            own = counts
        else:
            own = counts.join(map_texts(part, "term string", words).distinct(), "term")
        frequency = {r["term"]: r["n"] for r in own.collect()}
        yield build_index(texts, frequency, n, total / n)


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.6, overlap: float = 0.8,
               shard: int = 5_000) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row a text and item."""
    def search(index):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(part):
            rows = [(i, index.items[item][0], *values)
                    for index in (shared.value,)
                    for i, text in enumerate(part.column("text").to_pylist())
                    for item, *values in leaks_in(text, index, share, overlap)]
            at, items, *values = list(zip(*rows)) or [()] * 5
            return [part.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(items).cast(pa.int64()) if numeric else pa.array(items, pa.string()),
                    *(pa.array(v, pa.float64()) for v in values)]

        return map_texts(docs.select("doc_id", "text"), schema, run)

    kind = type_of(benchmark, "item_id")
    numeric = kind in ("bigint", "int", "smallint", "tinyint")
    schema = (f"doc_id {type_of(docs, 'doc_id')}, item_id {'bigint' if numeric else 'string'}, "
              "score double, question_overlap double, answer_overlap double")
    found = [search(index) for index in indexes(benchmark, shard)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    for other in found[1:]:
        found[0] = found[0].unionByName(other)
    return found[0].groupBy("doc_id", "item_id").agg(
        *(F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5,
                      overlap: float = 0.8, shard: int = 5_000) -> DataFrame:
    """The documents, all columns, that contain no item; rows are judged in place."""
    for index in indexes(benchmark, shard):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches, shared=shared):
            for part in slices(batches, "text"):
                yield part.filter(pa.array([not leaks_in(t, shared.value, share, overlap)
                                            for t in part.column("text").to_pylist()], pa.bool_()))

        docs = in_batches(docs, keep, docs.schema)
    return docs
