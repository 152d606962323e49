"""Deletes later copies of repeated runs of lines, found with a suffix array over line ids.

A text is the sequence of its lines that are not blank, each named by 128 bits of its stripped
content. A run of consecutive lines with ``min_words`` words or more that occurred before, in an
earlier document (by doc_id, nulls first, then by a hash of the text) or further up in the same
one, is deleted wherever it stands again; runs may overlap themselves.

The suffixes' order comes from prefix doubling: ranks by the first line, then by the first 2, 4,
8 ... lines, each round from the pairs (rank, rank of the suffix 2^k lines on). A round sorts the
distinct pairs by range partitions and numbers them in that order. Suffixes with equal ranks share
their prefix, so a group of equal ranks is an interval of the suffix array whose longest common
prefix has that many lines. Depths between two powers of two need no round of their own: equal
ranks at a run's start and at the place where its last 2^k lines begin make the whole run equal.

A repeated run with enough words is the union of shortest such runs, counted from each of its
lines to the right and to the left. So only those are looked up, and doubling ends at the longest
of them (every line has a word: at most ``min_words`` lines, seven rounds for 50). Only what can
still repeat is carried on: lines that occur once end a sequence, stretches between them with too
few words are left out, and so are suffixes whose rank nobody shares. No group is ever gathered:
groups are reduced to their size and first place and joined back.

Copies that begin or end within lines are found by their words (see passages): whatever line
breaks there are, later copies of ``min_words`` words or more go, and long lines are cut at the
passage's edges. A line of fewer than UNIT words goes whole or stays, so a passage that has its
edge in one must have enough words without it. Within one document a copy counts if it has no
words in common with the first.

Lines and stretches come from one pass over the texts; what occurs once is never sent with a place.
Keys that a large share of rows have are joined by broadcast, so no task gets all their rows.
Tables of a round are written to the shared folder, and removed when the next one is.

Defined results: null texts stay null, and empty ones empty; blank lines stay unless the line
before them was deleted; a text whose lines are all copies becomes empty, and its row stays. Rows
that agree in doc_id and text are one document and get the same result. All columns are kept;
only text is changed.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tierlake.llm.common import (
    Stored, free_name, in_batches, join_counted, join_to_texts, map_texts, place_of, slices,
    type_of)
from tierlake.llm.passages import (
    PASS_CHARS, STRETCHES, Words, covered, later_places, lists_of, stretches_of)
from tierlake.session import materialise

MIN_WORDS = 50
#: A line of fewer words is never cut.
UNIT = 8
_WORD = re.compile(r"\S+")
_LOW = (1 << 32) - 1


def content_lines(text: str | None) -> list[str]:
    return [line for line in map(str.strip, (text or "").split("\n")) if line]


def _shapes(texts: DataFrame, least: int) -> DataFrame:
    """A row a text, from one pass over it: place, its lines that are not blank (128 bits and
    number of words each) and its stretches (see passages)."""
    def run(part):
        words = Words(part.column("text"))
        first, stop = words.lines()
        text = words.bytes.tobytes()
        names = b"".join(xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(
            words.begin[first].tolist(), words.end[stop - 1].tolist()))
        halves = np.frombuffer(names, dtype="<i8").reshape(-1, 2)
        of = words.owner[first]
        return [part.column("place"), *(lists_of(v, of, part.num_rows, t) for v, t in (
            (halves[:, 0], np.int64), (halves[:, 1], np.int64), (stop - first, np.int32))),
            *stretches_of(words, least)]

    return map_texts(texts, f"place {type_of(texts, 'place')}, h1 array<bigint>, "
                     f"h2 array<bigint>, words array<int>, {STRETCHES}", run, most=PASS_CHARS)


def _repeated_in_order(rows: DataFrame, keys: list[str], stored=materialise) -> DataFrame:
    """The keys that several rows have, each with a rank in the order of the keys, and how many.

    Sorted range partitions make the running ids rise with the keys; written, they are final.
    """
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    ordered = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(ordered.select(*keys, F.monotonically_increasing_id().alias("next_rank"), "n"),
                  "ranks")


def stretches(pos: np.ndarray) -> np.ndarray:
    """For each of the ascending places, how many follow without a gap, itself included."""
    n = len(pos)
    ends = np.flatnonzero(np.append(np.diff(pos) != 1, True))
    return ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1


def _runs_of(words: np.ndarray, left: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and lines of the shortest runs with so many words from each line on and up to it, in
    order; left: how many lines follow in the same stretch, itself included."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n = len(words)
    last = np.arange(n) + left  # end of the stretch
    stop = np.searchsorted(total, total[:-1] + least)  # lines [i, stop) are the shortest from i
    there = np.flatnonzero(stop <= last)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1  # [start, i] up to i
    till = np.flatnonzero((start >= 0) & (last[start] > np.arange(n)))
    found = np.unique(np.concatenate([there << 32 | stop[there] - there,
                                      start[till] << 32 | till + 1 - start[till]]))
    return found >> 32, found & _LOW


def shortest_runs(words: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int]]:
    return list(zip(*(x.tolist() for x in _runs_of(words, left, least))))


def _values(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Of the entries of all lists, one after the other: their row, as bits above 32, and value."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes) << 32, column.flatten()


def _sequences(lines: DataFrame, least: int) -> DataFrame:
    """A row a document: places and ranks of its lines, starts and lengths of its shortest runs.

    collect_set drops repeated rows before they meet; a document's lines are bounded by its text.
    """
    def run(batches):
        for part in batches:
            row, lines = _values(part.column("lines"))
            pos, rank, words = (lines.field(c).to_numpy(zero_copy_only=False)
                                for c in ("pos", "rank", "words"))
            pos = row + pos
            order = np.argsort(pos)
            pos, rank, words = pos[order], rank[order], words[order]
            first, length = _runs_of(words, stretches(pos), least)
            used = np.cumsum(np.bincount(first, minlength=len(pos) + 1) - np.bincount(
                first + length, minlength=len(pos) + 1))[:len(pos)] > 0
            start, pos, rank = pos[first], pos[used], rank[used]
            some = np.unique(pos >> 32)
            yield pa.RecordBatch.from_arrays([
                part.column("place").take(pa.array(some)),
                *(lists_of(v, np.searchsorted(some, of >> 32), len(some), t) for v, of, t in (
                    (pos & _LOW, pos, np.int32), (rank, pos, np.int64),
                    (start & _LOW, start, np.int32), (length, start, np.int32)))],
                names=["place", "pos", "rank", "start", "length"])

    grouped = lines.groupBy("place").agg(
        F.collect_set(F.struct("pos", "rank", "words")).alias("lines"))
    return in_batches(grouped, run, f"place {type_of(lines, 'place')}, pos array<int>, "
                      "rank array<bigint>, start array<int>, length array<int>")


def _flatten(sequences: DataFrame, columns: str, pick) -> DataFrame:
    """pick(pos, rank, start, length) gives equally long columns for all documents of a batch; pos
    and start, and its first column, have the document's row above 32 bits."""
    names = ["place", *columns.split()]

    def run(batches):
        for part in batches:
            (of_line, pos), (_, rank), (of_run, start), (_, length) = (
                (row, v.to_numpy(zero_copy_only=False).astype(np.int64))
                for row, v in map(_values, part.columns[1:]))
            at, *rest = pick(of_line + pos, rank, of_run + start, length)
            yield pa.RecordBatch.from_arrays(
                [part.column("place").take(pa.array(at >> 32)), pa.array(at & _LOW),
                 *map(pa.array, rest)], names=names)

    return in_batches(
        sequences.select("place", "pos", "rank", "start", "length"), run,
        f"place {type_of(sequences, 'place')}, " + ", ".join(f"{c} bigint" for c in names[1:]))


def _found(pos: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each place in the ascending ones, and whether it is there."""
    i = np.searchsorted(pos, where)
    return np.minimum(i, max(len(pos) - 1, 0)), np.append(pos, -1)[i] == where


def _copies(sequences: DataFrame, depth: int, stored: Stored) -> DataFrame:
    """(place, start, length), stored, of runs of depth .. 2 * depth - 1 lines with an earlier copy."""
    def pick(pos, rank, start, length):
        chosen = (length >= depth) & (length < 2 * depth)
        start, length = start[chosen], length[chosen]
        (head, one), (tail, other) = (_found(pos, x) for x in (start, start + length - depth))
        there = one & other  # else the rank there is nobody else's
        return start[there], length[there], rank[head[there]], rank[tail[there]]

    runs = stored(_flatten(sequences, "start length head tail", pick), "runs")
    place = F.struct("place", "start")
    first = stored(runs.groupBy("length", "head", "tail").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    copies = stored(join_counted(runs, first, ["length", "head", "tail"])
                    .filter(place != F.col("first")).select("place", "start", "length"), "copies")
    stored.drop(runs, first)
    return copies


def _doubled(sequences: DataFrame, depth: int, stored: Stored) -> DataFrame:
    """Sequences, stored, with ranks by 2 * depth lines, of the suffixes that longer runs need and that share theirs."""
    def pick(pos, rank, start, length):
        longer = length >= 2 * depth
        start, length = start[longer], length[longer]
        first = np.searchsorted(pos, start)
        stop = np.searchsorted(pos, start + length - 2 * depth, side="right")
        needed = np.cumsum(np.bincount(first, minlength=len(pos) + 1) - np.bincount(
            stop, minlength=len(pos) + 1))[:len(pos)] > 0
        second, there = _found(pos, pos + depth)
        wanted = needed & there
        return pos[wanted], rank[wanted], rank[second[wanted]]

    pairs = stored(_flatten(sequences, "pos rank second", pick), "pairs")
    ranks = _repeated_in_order(pairs, ["rank", "second"], stored)
    own = join_counted(pairs, ranks, ["rank", "second"]).groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("pos").cast("int").alias("pos"), F.col("next_rank").alias("rank")))).alias("lines"))
    runs = sequences.select("place", "start", "length").filter(
        F.exists("length", lambda m: m >= 2 * depth))
    made = stored(own.join(runs, "place").select(
        "place", F.col("lines.pos").alias("pos"), F.col("lines.rank").alias("rank"), "start",
        "length"), "sequences")
    stored.drop(pairs, ranks)
    return made


def repeated_runs(shapes: DataFrame, min_words: int, stored: Stored) -> DataFrame:
    """(place, runs): later copies in a document as (start, length), in content lines."""
    each = shapes.select("place", F.posexplode(F.arrays_zip("h1", "h2", "words")).alias(
        "pos", "line")).select("place", "pos", "line.h1", "line.h2", "line.words")
    ranks = _repeated_in_order(each, ["h1", "h2"], stored)
    ranked = join_counted(each, ranks, ["h1", "h2"]).withColumnRenamed("next_rank", "rank")
    sequences = stored(_sequences(ranked, min_words), "sequences")
    stored.drop(ranks)
    longest = sequences.agg(F.max(F.array_max("length"))).first()[0] or 0
    rounds, depth = [], 1
    while True:
        rounds.append(_copies(sequences, depth, stored))
        if 2 * depth > longest:
            break
        longer = _doubled(sequences, depth, stored)
        stored.drop(sequences)
        sequences, depth = longer, 2 * depth
    found = functools.reduce(DataFrame.unionByName, rounds)
    runs = stored(found.groupBy("place").agg(
        F.collect_set(F.struct("start", "length")).alias("runs")), "line-runs")
    stored.drop(sequences, *rounds)
    return runs


def _cut(line: str, gone: np.ndarray) -> str:
    """The line without the words that are gone."""
    starts = [m.start() for m in _WORD.finditer(line)]
    ends = [*starts[1:], len(line)]
    kept = "".join(line[a:b] for a, b, no in zip(starts, ends, gone) if not no)
    return line[:starts[0]] + (kept.rstrip() if gone[-1] else kept)


def without(text: str | None, runs: list[tuple[int, int]], places: list[int] = (),
            least: int = MIN_WORDS) -> tuple[str | None, int]:
    """The text without runs of content lines and without the windows of ``least`` words at the
    places (see ``covered``), and how many lines that took or cut."""
    lines = (text or "").split("\n")
    deleted = {i for start, length in runs for i in range(start, start + length)}
    if len(places):
        sizes = [len(line.split()) for line in lines]
        mask = covered(places, [n for n in sizes if n], least, UNIT)
        gone_before = np.append(0, np.cumsum(mask)).tolist()
    else:
        sizes = [int(line != "" and not line.isspace()) for line in lines]
    kept, place, word, dropping, taken = [], 0, 0, False, 0
    for line, size in zip(lines, sizes):
        if size:
            gone = gone_before[word + size] - gone_before[word] if len(places) else 0
            dropping = place in deleted or gone == size
            taken += dropping or gone > 0
            if gone and not dropping:
                line = _cut(line, mask[word:word + size])
            word += size
            place += 1
        if not dropping:
            kept.append(line)
    return (text, 0) if not taken else ("\n".join(kept), taken)


def delete_copies(docs: DataFrame, min_words: int = MIN_WORDS,
                  count_as: str | None = None) -> DataFrame:
    """All rows and columns, texts without later copies; count_as adds the lines deleted or cut."""
    fields = docs.schema.fields + ([StructField(count_as, IntegerType())] if count_as else [])
    schema, text_at = StructType(fields), docs.columns.index("text")

    def run(batches):
        for part in slices(batches, "text"):
            columns = part.columns
            runs, places = columns[-2:]
            start, length = (_values(runs)[1].field(c).to_pylist() for c in ("start", "length"))
            place = _values(places)[1].to_numpy(zero_copy_only=False)
            ends = [np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(
                zero_copy_only=False))).tolist() for x in (runs, places)]
            made = [without(t, list(zip(start[a:b], length[a:b])), place[c:d], min_words)
                    for t, a, b, c, d in zip(columns[text_at].to_pylist(), ends[0], ends[0][1:],
                                             ends[1], ends[1][1:])]
            columns[text_at] = pa.array([t for t, _ in made], pa.string())
            columns = columns[:len(docs_columns)]
            if count_as:
                columns.append(pa.array([n for _, n in made], pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=schema_names)

    docs_columns, schema_names = docs.columns, schema.names
    stored = Stored(docs.sparkSession)
    place = place_of(docs)
    texts = docs.select(place.alias("place"), "text")
    shapes = stored(_shapes(texts, min_words), "shapes")
    runs = repeated_runs(shapes, min_words, stored)
    places = later_places(texts, shapes, min_words, stored)
    stored.drop(shapes)
    key = free_name("place", docs.columns)
    found = stored(runs.unionByName(places, allowMissingColumns=True).groupBy(
        F.col("place").alias(key)).agg(*(F.first(c, ignorenulls=True).alias(
            free_name(c, docs.columns)) for c in ("runs", "places"))), "copies")
    stored.drop(runs, places)
    joined = join_to_texts(docs.withColumn(key, place), found, [key], "left", stored).drop(key)
    # Most texts have no copies and stay out of Python.
    touched = functools.reduce(Column.__or__, (F.col(c).isNotNull() for c in joined.columns[-2:]))
    same = joined.filter(~touched).select(*docs.columns, *(
        [F.lit(0).alias(count_as)] if count_as else []))
    return in_batches(joined.filter(touched), run, schema).union(same)
