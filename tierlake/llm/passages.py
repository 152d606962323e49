"""Places of repeated passages of ``least`` words, wherever lines begin and end.

Texts are cut anew, at places that their words choose: the sign of a window of ``least`` words is
the smallest hash of the runs of SHORT words in it, and a stretch is all that neighbouring windows
of one sign cover. Copies of a passage have the same stretches inside, whatever is around them.

A stretch that several documents have needs no more: all but the first are copies. Where stretches
of a sign differ (at a passage's edges, around a changed word, or if a text repeats itself), the
windows of the first document of each are compared one by one, by 128 bits. Nothing is left out by
this: equal windows have equal signs, and the first document with a window is the first one with
its stretch as well. What a text repeats of itself is found in that text.

Words are cut and named in whole slices of texts, from their bytes in UTF-8.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import Stored, in_batches, join_counted, join_to_texts, slices

#: Odd, so that powers have inverses.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
#: Words of the runs that choose stretches.
SHORT = 20
#: Words of more bytes are named one by one.
_LONG = 64
#: Characters of str.split, as bytes: single ones, and first bytes of longer ones with the rest.
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE = {0xC2: (0x85, 0xA0), 0xE1: (0x9A80,), 0xE3: (0x8080,),
         0xE2: (*range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF, 0x819F)}
_LEADS = np.isin(np.arange(256), list(_WIDE))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Words:
    """The words of a slice of texts, one after the other, as str.split cuts them.

    owner, ids: text and 64 bits of a word; begin, end: its bytes; begins: each text's first word.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset:][:len(texts) + 1].astype(np.int64)
        self.bytes = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
        at -= at[0]
        word = ~self._spaces()
        some = at[:-1][np.diff(at) > 0], at[1:][np.diff(at) > 0] - 1
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[some[0]], last[some[1]] = word[some[0]], word[some[1]]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.searchsorted(self.begin, at)
        self.begins = ends[:-1]
        self.owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        self.ids = self._named()

    def _spaces(self) -> np.ndarray:
        space = _SPACE[self.bytes]
        leads = np.flatnonzero(_LEADS[self.bytes])
        for lead, rests in _WIDE.items() if len(leads) else ():
            at = leads[self.bytes[leads] == lead]
            rest = self.bytes[at + 1].astype(np.int64)
            if lead != 0xC2:
                rest = rest << 8 | self.bytes[at + 2]
            at = at[np.isin(rest, rests)]
            for k in range(2 if lead == 0xC2 else 3):
                space[at + k] = True
        return space

    def _named(self) -> np.ndarray:
        padded = np.append(self.bytes, np.zeros(8, np.uint8))
        eight = np.ndarray(len(self.bytes) + 1, "<u8", padded, strides=(1,))
        size = self.end - self.begin
        made = _finished(eight[self.begin] & _MASKS[np.minimum(size, 8)],
                         size.astype(np.uint64))
        more, k = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            block = eight[self.begin[more] + k] & _MASKS[np.minimum(size[more] - k, 8)]
            made[more] = _finished(block, made[more])
            k += 8
            more = more[size[more] > k]
        for i in np.flatnonzero(size > _LONG):
            made[i] = xxhash.xxh3_64_intdigest(self.bytes[self.begin[i]:self.end[i]])
        return made

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the lines with a word: their first words, and the words after their last ones."""
        if not len(self.begin):
            return self.begin, self.begin
        breaks = np.flatnonzero(self.bytes == 10)
        line = np.searchsorted(breaks, self.begin) + self.owner
        first = np.append(0, np.flatnonzero(np.diff(line)) + 1)
        return first, np.append(first[1:], len(line))


def _finished(block: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Bits of both mixed; for one value of either, different ones of the other stay different."""
    made = block * np.uint64(_BASES[0]) + before * np.uint64(_BASES[1])
    for shift, by in ((32, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        made ^= made >> np.uint64(shift)
        made *= np.uint64(by)
    return made ^ (made >> np.uint64(32))


@functools.lru_cache(16)
def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(size, base, np.uint64)), dtype=np.uint64)


def window_hashes(ids: np.ndarray, size: int, base: int) -> np.ndarray:
    """Of each run of so many words: the sum of word i times base^i, modulo 2^64."""
    if len(ids) < size:
        return np.empty(0, np.uint64)
    room = 1 << int(len(ids)).bit_length()
    total = np.append(np.uint64(0), np.cumsum(ids * _powers(base, room)[:len(ids)],
                                              dtype=np.uint64))
    inverse = _powers(pow(base, -1, 1 << 64), room)[:len(ids) - size + 1]
    return (total[size:] - total[:-size]) * inverse


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:])


def signs_of(ids: np.ndarray, least: int) -> np.ndarray:
    """The smallest hash in each window of ``least`` words."""
    if len(ids) < least:
        return np.empty(0, np.int64)
    short = min(SHORT, least)
    return sliding_least(_mixed(window_hashes(ids, short, _BASES[0])), least - short + 1).view(
        np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    return (values ^ (values >> np.uint64(29))) * np.uint64(_BASES[1])


def _windows_of(owner: np.ndarray, ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows that lie in one text, and their signs."""
    signs = signs_of(ids, least)
    places = np.flatnonzero(owner[:len(signs)] == owner[least - 1:]) if len(signs) else signs
    return places, signs[places]


def lists_of(values: np.ndarray, of: np.ndarray, size: int, kind: type) -> pa.ListArray:
    """A list a row, from the values of all rows and the ascending rows they are of."""
    ends = np.searchsorted(of, np.arange(size + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind)))


#: Characters of the texts that are cut at once: arrays of their words stay in a core's cache.
PASS_CHARS = 1_000_000
#: Columns of ``stretches_of``: sign, words of the stretch, its first window, the number of its
#: windows, and whether the text has the sign in this stretch only, around one place.
STRETCHES = ("sign array<bigint>, whole array<bigint>, at array<int>, n array<int>, "
             "single array<boolean>")


def stretches_of(words: Words, least: int) -> list[pa.ListArray]:
    size, owner, ids = len(words.begins), words.owner, words.ids
    places, signs = _windows_of(owner, ids, least)
    of = owner[places]
    new = np.ones(len(signs), bool)
    new[1:] = (np.diff(signs) != 0) | (np.diff(of) != 0)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(signs)))
    sign, of_stretch, first = signs[starts], of[starts], places[starts]
    whole = _range_hashes(ids, first, first + counts + least - 1)
    order = np.lexsort((sign, of_stretch))
    alike = ((np.diff(sign[order]) == 0) & (np.diff(of_stretch[order]) == 0))
    single = counts <= least - min(SHORT, least) + 1
    single[order[1:][alike]] = False
    single[order[:-1][alike]] = False
    return [lists_of(v, of_stretch, size, t) for v, t in (
        (sign, np.int64), (whole.view(np.int64), np.int64),
        (first - words.begins[of_stretch] if len(first) else first, np.int32), (counts, np.int32),
        (single, bool))]


def _windows(batches, least: int):
    """(place, at, windows, h1, h2) of the windows that have one of the row's signs: one by one
    those that have words in common with the text's first window of their kind, or are that; the
    others, copies of it, in runs without h1 and h2."""
    for part in slices(batches, "text", PASS_CHARS):
        words = Words(part.column("text"))
        places, found = _windows_of(words.owner, words.ids, least)
        of, wanted = words.owner[places], np.zeros(len(places), bool)
        ends = np.searchsorted(of, np.arange(part.num_rows + 1))
        for row, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
            wanted[lo:hi] = np.isin(found[lo:hi], part.column("signs")[row].values.to_numpy())
        places, of = places[wanted], of[wanted]
        h1, h2 = (window_hashes(words.ids, least, b)[places].view(np.int64) for b in _BASES)
        order = np.lexsort((places, h2, h1, of))
        new = np.ones(len(order), bool)
        for kind in (of, h1, h2):
            new[1:] &= np.diff(kind[order]) == 0
        new[1:] = ~new[1:]
        group = np.cumsum(new) - 1
        near = np.empty(len(order), bool)
        near[order] = places[order] - places[order][new][group] < least
        begin = np.flatnonzero(near | np.append(True, near[:-1] | (np.diff(places) != 1)
                                                | (np.diff(of) != 0))[:len(near)])
        near, at, of = near[begin], places[begin] - words.begins[of[begin]], of[begin]
        yield pa.RecordBatch.from_arrays(
            [part.column("place").take(pa.array(of)), pa.array(at.astype(np.int32)),
             pa.array(np.diff(np.append(begin, len(places))).astype(np.int32)),
             *(pa.array(h[begin], mask=~near) for h in (h1, h2))],
            names=["place", "at", "windows", "h1", "h2"])


def later_places(texts: DataFrame, shapes: DataFrame, least: int, stored: Stored) -> DataFrame:
    """(place, places): windows that stood before, neighbours as start * 2^32 + number.

    Before is an earlier document, or the same one without common words. texts: (place, text);
    shapes: (place, columns of STRETCHES), stored.
    """
    each = shapes.select("place", F.explode(F.arrays_zip(
        "sign", "whole", "at", "n", "single")).alias("s")).select(
        "place", "s.sign", "s.whole", "s.at", F.col("s.n").alias("windows"), "s.single")
    # A sign alone is sent first: few are there twice.
    twice = stored(each.groupBy("sign").agg(
        F.sum(F.when(F.col("single"), 1).otherwise(2)).alias("n")).filter("n > 1"), "signs")
    held = stored(join_counted(each, twice, ["sign"]).drop("n"), "stretches")
    alike = stored(held.groupBy("sign", "whole").agg(
        F.count("*").alias("rows"), F.min("place").alias("first"),
        F.bool_and("single").alias("single")), "alike")
    several = stored(alike.groupBy("sign").agg(F.sum("rows").alias("n"), (
        ~F.bool_and("single") | (F.count("*") > 1)).alias("differ")), "several")
    about = stored(join_counted(alike, several, ["sign"]).select(
        "sign", "whole", "first", "differ", F.col("rows").alias("n")), "shared")
    found = stored(join_counted(held, about, ["sign", "whole"]).select(
        "place", "sign", "at", "windows", (F.col("place") == F.col("first")).alias("is_first"),
        "differ"), "found")
    sure = found.filter("NOT is_first").select("place", "at", "windows")
    wanted = stored(found.filter("is_first AND differ").groupBy("place").agg(
        F.collect_set("sign").alias("signs")), "wanted")
    kind = texts.schema["place"].dataType.simpleString()
    compared = stored(in_batches(
        join_to_texts(texts, wanted, ["place"], "inner", stored).select("place", "text", "signs"),
        functools.partial(_windows, least=least),
        f"place {kind}, at int, windows int, h1 bigint, h2 bigint"), "windows")
    inside = compared.filter("h1 IS NULL").select("place", "at", "windows")
    single = compared.filter("h1 IS NOT NULL")
    first = stored(single.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("place").alias("first")).filter("n > 1"), "first")
    copies = join_counted(single, first, ["h1", "h2"]).filter(
        F.col("place") != F.col("first")).select("place", "at", "windows")
    places = stored(sure.unionByName(inside).unionByName(copies).groupBy("place").agg(
        F.collect_set(F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("windows"))
        .alias("places")), "places")
    stored.drop(twice, held, alike, several, about, found, wanted, compared, first)
    return places


def _range_hashes(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the words [start, end): the sum of word i times base^i, modulo 2^64."""
    room = 1 << int(len(ids)).bit_length()
    base = _BASES[1]
    total = np.append(np.uint64(0), np.cumsum(ids * _powers(base, room)[:len(ids)],
                                              dtype=np.uint64))
    return (total[end] - total[start]) * _powers(pow(base, -1, 1 << 64), room)[start]


def covered(places: np.ndarray, lines: list[int], least: int, unit: int) -> np.ndarray:
    """Which words are in repeated windows, start * 2^32 + number. lines: words of each line.

    A line of fewer than ``unit`` words is covered as a whole or not at all.
    """
    ends = np.cumsum(lines)
    mask = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    places = np.sort(np.asarray(places, np.int64))
    starts = places >> 32
    stops = np.maximum.accumulate(starts + (places & (1 << 32) - 1))
    new = np.flatnonzero(np.append(True, starts[1:] > stops[:-1])[:len(starts)])
    runs = zip(starts[new].tolist(), stops[np.append(new[1:], len(starts))[:len(new)] - 1].tolist())
    for start, stop in runs:
        end = stop - 1 + least
        line = int(np.searchsorted(ends, start, side="right"))
        if lines[line] < unit and start > ends[line] - lines[line]:
            start = int(ends[line])
        line = int(np.searchsorted(ends, end, side="left"))
        if lines[line] < unit and end < ends[line]:
            end = int(ends[line] - lines[line])
        if end - start >= least:
            mask[start:end] = True
    return mask
