"""Cross-entropy difference of a target and a background language model.

Both models are word bigrams of the same kind over one vocabulary, all words of all documents. The
background model counts all documents; the target model those labelled of good quality and not
toxic. A word w after a history h (the word before, or the start of the text) has

    p(w | h) = (n(h, w) + MU p(w)) / (n(h) + MU),    p(w) = (n(w) + 1) / (N + V)

with each model's own counts and V the number of words in the vocabulary. A document's score is the
mean over its words of -ln p_target + ln p_background: below zero, it reads more like the target
than documents at large.

How pairs of words meet their counts depends on how common the words are, the counts are the same.
The ``common`` most frequent words (a fixed number, so their pairs fit a dense table) are counted
in tasks first and broadcast. Every other pair has a rarer word and is sent to that word's bucket,
one place with the word before and, if common, the word after; the places that a slice of texts has
for a bucket are arrays of one row. There are as many buckets as give each BUCKET places, and a
word's places are all in one. There both pairs, the word, and the word as a history are counted
after one shuffle and two sorts: ln p is a sum of a part of the pair and one of the history, and
each word's places hold both of its own. What is left is to add up the parts by document: a bucket
sends back the sums of the documents of each slice as arrays of one row, at most one sum a place.

Which words are taken for common decides where pairs are counted and nothing else, so the list
comes from a share of the documents. Exact counts of all words follow, and a rarer word with over
HOT_SHARE of all places (and HOT_ROWS of them) joins the common ones before pairs are sent.

Words are named by 63 bits of a hash of their bytes, taken of all words of a slice at once: with a
hundred million words the chance that any two share a name is 0.0005. Documents of the target are
joined to texts by broadcast while the list of their ids is small, by shuffle beyond.

Defined results: words are runs without white space of the lower-case text; a null or empty text
has none and scores 0; conflicting labels of a document make it no target; without target
documents the target model is uniform. Null ids are scored and counted, and are no targets;
repeated rows count as often as they are there. Only doc_id, text and the labels are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tierlake.llm.common import (
    HOT_SHARE, Stored, in_batches, join_to_texts, slices, type_of)

MU = 20.0
#: So many words have their pairs counted in a dense table; this share of documents names them.
COMMON, SHARE = 1_500, 1 / 32
HOT_ROWS = 1_000_000
#: What may follow a rarer word besides a common one: a rarer one, or nothing.
RARER, END = -1, -2
#: So many words are named at once.
_FLUSH = 200_000
_PLACES, _BATCH = 2_000_000, 200_000
#: Characters of a slice: a task holds some ten numbers of each of its words.
_CHARS = 1_000_000
#: Places of a bucket; one with a word of HOT_ROWS has up to as many more.
BUCKET = 1_000_000


def _names(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words, 8 bytes at a time; words of up to 8 bytes share one only if their lengths
    differ. ``data`` has 8 bytes more than the last word."""
    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    named = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, left, words = starts, lengths, np.arange(len(starts))
    while len(words):
        eight = eights[at] & _MASKS[np.minimum(left, 8)]
        mixed = (named[words] ^ eight) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        named[words] = mixed ^ (mixed >> np.uint64(29))
        more = np.flatnonzero(left > 8)
        at, left, words = at[more] + 8, left[more] - 8, words[more]
    return named


#: The first bytes of eight, by how many.
_MASKS = np.array([2 ** (8 * i) - 1 for i in range(9)], dtype=np.uint64)


class Codes:
    """Numbers of words: their place in ``common``, a list of names, or else their name (< 0)."""

    def __init__(self, common: list[int]):
        names = np.array(common, dtype=np.int64)
        self.rank = np.argsort(names)
        self.names = names[self.rank]
        self.rest, self.start = len(common), len(common) + 1
        #: Whether a common name begins with these 20 bits of its 63: few others do.
        self.begins = np.zeros(2 ** 20, dtype=bool)
        self.begins[self._begin(names)] = True

    def __len__(self) -> int:
        return len(self.names)

    @staticmethod
    def _begin(names: np.ndarray) -> np.ndarray:
        return (names >> 43) + 2 ** 20

    def _of_words(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        codes = (_names(data, starts, lengths) >> np.uint64(1)).view(np.int64) + np.int64(-2 ** 63)
        if len(self):
            maybe = np.flatnonzero(self.begins[self._begin(codes)])
            at = np.minimum(np.searchsorted(self.names, codes[maybe]), len(self) - 1)
            found = self.names[at] == codes[maybe]
            codes[maybe[found]] = self.rank[at[found]]
        return codes

    def of(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many words each text has; of each word, the text's row, the word before (or the
        start symbol) and the word. Words are runs without ASCII's six white-space characters."""
        texts = [(t or "").lower().encode() for t in part.column("text").to_pylist()]
        data = b"\n" + b"\n".join(texts) + b"\n" + bytes(8)
        letters = np.frombuffer(data, dtype=np.uint8)[:-8]
        white = (letters == 32) | (letters - np.uint8(9) < 5)
        edges = np.flatnonzero(white[1:] != white[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        codes = np.concatenate([np.empty(0, dtype=np.int64), *(
            self._of_words(data, starts[i:i + _FLUSH], (ends - starts)[i:i + _FLUSH])
            for i in range(0, len(starts), _FLUSH))])
        until = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        lengths = np.diff(until, prepend=0)
        before = np.append(self.start, codes[:-1])[:len(codes)]
        before[(until - lengths)[lengths > 0]] = self.start
        return lengths, np.repeat(np.arange(len(texts)), lengths), before, codes


def frequent_words(docs: DataFrame, size: int) -> list[int]:
    """Names of the most frequent words."""
    counted = counts(docs.select("text", F.lit(False).alias("target")), [])
    top = counted.filter("key < 0").orderBy(F.desc("n"), "key").limit(size)
    return [r["key"] for r in top.collect()]


def counts(texts: DataFrame, common: list[int]) -> DataFrame:
    """(key, n, target): how often common words follow each other (key: before * size + after, all
    rarer words are one), in all and in target documents; how often each rarer word (key: its
    name) is there in all."""
    size = len(common) + 2

    def run(batches):
        codes = Codes(common)
        pairs = np.zeros((2, size * size), dtype=np.int64)
        rare, held = [], 0
        for part in slices(batches, "text", _CHARS):
            _, row, before, after = codes.of(part)
            is_target = np.array([bool(t) for t in part.column("target").to_pylist()])
            rare.append(after[after < 0])
            held += len(rare[-1])
            pair = np.where(before < 0, codes.rest, before) * size + np.where(
                after < 0, codes.rest, after)
            np.add.at(pairs[0], pair, 1)
            np.add.at(pairs[1], pair[is_target[row]], 1)
            if held > _PLACES:
                yield from counted(rare)
                held = 0
        yield from counted(rare)
        found = np.flatnonzero(pairs[0])
        yield from rows(found, pairs[0, found], pairs[1, found])

    def counted(rare):
        """Rows of the words of a list of arrays, which is emptied."""
        if rare:
            words = np.concatenate(rare)
            rare.clear()
            words.sort()
            first = np.flatnonzero(np.append(True, words[1:] != words[:-1])[:len(words)])
            yield from rows(words[first], np.diff(first, append=len(words)))

    def rows(keys, n, target=None):
        target = np.zeros_like(n) if target is None else target
        for i in range(0, len(keys), _BATCH):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[i:i + _BATCH]) for c in (keys, n, target)], names=["key", "n", "target"])

    return in_batches(
        texts.select("text", "target"), run, "key bigint, n bigint, target bigint").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("target").alias("target"))


@dataclass
class Dense:
    """One model's counts of pairs of common words; parts of ln p of histories; MU p(w)."""

    pairs: np.ndarray
    histories: np.ndarray
    base: np.ndarray
    total: float

    def ln_pairs(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The parts of ln p of pairs. A table of them would be twice as large as the counts."""
        return np.log(self.pairs[before, after] + self.base[after])


def _dense(counted: np.ndarray, size: int, vocabulary: int) -> Dense:
    table = counted.reshape(size, size)
    total = max(float(table.sum()) + vocabulary, 1.0)
    base = MU * (table.sum(axis=0) + 1) / total
    pairs = table.astype(np.min_scalar_type(int(table.max(initial=0))))
    return Dense(pairs, np.log(table.sum(axis=1) + MU), base, total)


def fit(texts: DataFrame, common: list[int], stored: Stored) -> tuple[list[int], list[Dense]]:
    """The common words, hot ones included, and the target's and the background's dense parts."""
    while True:
        counted = stored(counts(texts, common), "counts")
        places = counted.filter("key >= 0").agg(F.sum("n")).first()[0] or 0
        hot = [r["key"] for r in counted.filter("key < 0").filter(
            F.col("n") > max(places * HOT_SHARE, HOT_ROWS)).collect()]
        if not hot:
            break
        common = common + hot  # at most 1 / HOT_SHARE; there are none in the next round
        stored.drop(counted)
    size = len(common) + 2
    pairs = counted.filter("key >= 0").toArrow()
    vocabulary = counted.filter("key < 0").count() + len(common)
    models = []
    for column in ("target", "n"):
        table = np.zeros(size * size, dtype=np.int64)
        table[pairs.column("key").to_numpy()] = pairs.column(column).to_numpy()
        models.append(_dense(table, size, vocabulary))
    stored.drop(counted)
    return common, models


def _sums(texts: DataFrame, common: list[int], models: list[Dense]) -> DataFrame:
    """(doc_id, n_words, target, background): each document's sums of ln p by both models."""
    shared = texts.sparkSession.sparkContext.broadcast((common, models))
    rarer = int(models[1].pairs[:, len(common)].sum(dtype=np.int64))
    buckets = max(1, -(-rarer // BUCKET))
    id_type, id_name = to_arrow_type(texts.schema["doc_id"].dataType), type_of(texts, "doc_id")
    # A slice's documents are numbered; ``docs`` has twice the number, and 1 more for the target.
    places = {"docs": "int", "keys": "bigint", "before": "bigint", "after": "int"}
    documents = {"doc_ids": id_name, "n_words": "bigint"}
    sums = {"target": "double", "background": "double"}
    kinds = {c: {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[k]
             for c, k in (places | sums | {"n_words": "bigint"}).items()} | {"doc_ids": id_type}

    def rows(first: dict, columns, sizes: np.ndarray, **arrays: pa.Array) -> pa.RecordBatch:
        """Rows of the first columns and lists of the next so many values of each of the arrays."""
        ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        return pa.RecordBatch.from_pydict(first | {
            c: pa.ListArray.from_arrays(ends, arrays[c]) if c in arrays
            else pa.nulls(len(sizes), pa.list_(kinds[c])) for c in columns})

    sent, returned = places | documents | sums, {"docs": "int"} | documents | sums

    def run(batches):
        common, models = shared.value
        codes = Codes(common)
        for part in slices(batches, "text", _CHARS):
            lengths, row, before, after = codes.of(part)
            is_target = np.array([bool(t) for t in part.column("target").to_pylist()], dtype=int)
            n, name = len(lengths), part.column("ref")[0].as_py()
            both, known = (before >= 0) & (after >= 0), before >= 0
            ln_p = [(np.bincount(row[both], m.ln_pairs(before[both], after[both]), n)
                     - np.bincount(row[known], m.histories[before[known]], n)).astype(float)
                    for m in models]  # sums of nothing are whole numbers to bincount
            yield rows({"bucket": pa.array([name % buckets], pa.int32()),
                        "slice": pa.array([name])}, sent, np.array([n]),
                       doc_ids=as_array(part.column("doc_id")), n_words=pa.array(lengths),
                       target=pa.array(ln_p[0]), background=pa.array(ln_p[1]))
            rare = np.flatnonzero(after < 0)
            bucket = after[rare] % buckets
            order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
            rare, sizes = rare[order], np.bincount(bucket, minlength=buckets)
            follower = np.full(len(rare), END, dtype=np.int32)
            inside = np.flatnonzero(rare + 1 < len(row))
            inside = inside[row[rare[inside] + 1] == row[rare[inside]]]
            follower[inside] = np.maximum(after[rare[inside] + 1], RARER)
            found = np.flatnonzero(sizes)
            yield rows({"bucket": pa.array(found, pa.int32()),
                        "slice": pa.array(np.full(len(found), name))}, sent, sizes[found],
                       docs=pa.array((row * 2 + is_target[row])[rare], pa.int32()),
                       keys=pa.array(after[rare]), before=pa.array(before[rare]),
                       after=pa.array(follower))

    def as_array(column):
        return column.cast(id_type) if column.type != id_type else column

    def of_bucket(bucket: pa.Table) -> pa.Table:
        """The rows of documents, and for each row of places one with its documents' sums."""
        _, models = shared.value
        is_places = pc.is_valid(bucket.column("keys"))
        whole = bucket.filter(pc.invert(is_places)).select(["slice", *returned])
        bucket = bucket.filter(is_places)
        if not len(bucket):
            return whole
        docs, keys, before, after = (
            pc.list_flatten(bucket.column(c)).to_numpy() for c in places)
        ln_p = ln_places(models, docs % 2 == 1, keys, before, after)
        row = np.repeat(np.arange(len(bucket)), pc.list_value_length(bucket.column("docs")))
        # The places of a row are in the order of its documents.
        new = np.append(True, (docs[1:] != docs[:-1]) | (row[1:] != row[:-1]))
        document = np.cumsum(new) - 1
        made = rows({"slice": bucket.column("slice").combine_chunks()}, returned,
                    np.bincount(row[new], minlength=len(bucket)), docs=pa.array(docs[new]),
                    **{c: pa.array(np.bincount(document, p)) for c, p in zip(sums, ln_p)})
        return pa.concat_tables([whole, pa.Table.from_batches([made])],
                                promote_options="permissive")

    def of_slice(rows: pa.Table) -> pa.Table:
        is_whole = pc.is_valid(rows.column("doc_ids"))
        whole, rows = rows.filter(is_whole), rows.filter(pc.invert(is_whole))
        made = {c: pc.list_flatten(whole.column(c)).combine_chunks() for c in (*documents, *sums)}
        docs = pc.list_flatten(rows.column("docs")).to_numpy() // 2
        for c in sums:
            made[c] = pa.array(made[c].to_numpy() + np.bincount(
                docs, pc.list_flatten(rows.column(c)).to_numpy(), len(made[c])))
        return pa.table(list(made.values()), names=["doc_id", *list(made)[1:]])

    def listed(columns: dict) -> str:
        return ", ".join(f"{c} array<{kind}>" for c, kind in columns.items())

    return in_batches(
        texts.select("ref", "doc_id", "text", "target"), run,
        f"bucket int, slice bigint, {listed(sent)}").groupBy(
        "bucket").applyInArrow(
        of_bucket, f"slice bigint, {listed(returned)}").groupBy(
        "slice").applyInArrow(
        of_slice, f"doc_id {id_name}, n_words bigint, target double, background double")


def ln_places(models: list[Dense], is_target: np.ndarray, keys: np.ndarray, before: np.ndarray,
              after: np.ndarray) -> list[np.ndarray]:
    """The parts of ln p, by the target's and the background's model, that each place of some rarer
    words has; the places are all of these words."""
    order = np.lexsort((before, keys))
    keys, before, after = keys[order], before[order], after[order]

    def numbers(new):
        return np.cumsum(new) - 1

    new_key = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    word = numbers(new_key)
    pair = numbers(new_key | np.append(True, before[1:] != before[:-1])[:len(keys)])
    followed, ends = np.flatnonzero(after >= 0), after == END
    _, following = np.unique(word[followed] * (after.max(initial=0) + 1) + after[followed],
                             return_inverse=True)
    made = []
    for model, counts_in in zip(models, (is_target[order], np.ones(len(keys), dtype=bool))):
        def count(what, of=slice(None)):
            return np.bincount(what[counts_in[of]], minlength=int(what.max(initial=-1)) + 1)

        n = count(word)
        histories = np.log(n - np.bincount(word[counts_in & ends], minlength=len(n)) + MU)
        ln_p = np.log(count(pair)[pair] + (MU * (n + 1) / model.total)[word])
        ln_p -= np.where(ends, 0.0, histories[word])
        ln_p[followed] += np.log(count(following, followed)[following]
                                 + model.base[after[followed]])
        made.append(np.empty_like(ln_p))
        made[-1][order] = ln_p
    return made


def score(docs: DataFrame, labels: DataFrame, common: int = COMMON,
          share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, ce_target, ce_background, score) of every whole text, by the models of
    all the documents and of those that the labels make the target."""
    spark = docs.sparkSession
    stored = Stored(spark)
    targets = stored(labels.groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("target")).filter(
        F.col("target") & F.col("doc_id").isNotNull()), "targets")
    texts = join_to_texts(docs.select("doc_id", "text"), targets, ["doc_id"], "left", stored)
    sample = docs.select("text") if share >= 1 else docs.select("text").sample(share, seed=1)
    names, models = fit(texts, frequent_words(sample, common) if common else [], stored)
    sums = _sums(texts.withColumn("ref", F.monotonically_increasing_id()), names, models)
    # A text without words has sums of 0.
    mean = {m: (F.lit(0.0) - F.col(m)) / F.greatest("n_words", F.lit(1))
            for m in ("target", "background")}
    return sums.select("doc_id", "n_words", mean["target"].alias("ce_target"),
                       mean["background"].alias("ce_background"),
                       (mean["target"] - mean["background"]).alias("score"))
