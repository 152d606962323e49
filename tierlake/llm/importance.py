"""Documents resampled towards a target distribution, by importance weights of hashed n-grams.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; features are all
runs of one and two words, repeats counted, each hashed to one of BUCKETS by crc32. The corpus and
the target are counted by bucket, over whole texts: in tasks into arrays, then a row a bucket. The
gain of a bucket is the smoothed log ratio of target and corpus in thousandths, rounded down; a
document's weight is the floored mean of its features' gains, read from an array. A Gumbel draw
per document, from the hash of ``<seed>:<doc_id>``, is added to the weight, so that the documents
of largest score are a sample without replacement in proportion to the weights.

The cutoff among N eligible documents is found without a sort of all: a quantile sketch of the
scores gives a bracket around the wanted rank, exact counts above and inside it validate it (or it
is widened until they do), and only rows within the bracket are sorted. Rows above the cutoff are
then numbered in order: range partitions sorted within, plus the number of rows in those before.

Only the gains (BUCKETS numbers) and a row a range partition reach the driver. Scores are written
to the shared folder once; the texts are read twice.

Defined results: null texts and texts without a word have no features and weight 0; without
documents nothing is drawn. A null id draws as an empty one and ranks after equal scores with ids.
Repeated rows have equal scores, and each has a rank of its own. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import map_texts, slices, type_of
from tierlake.session import materialise

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Of the sketch, and of the first bracket on each side, as shares of the rows.
ACCURACY, BRACKET = 10_000, 0.002

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def features(text: str | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each run of one and two words."""
    words = _WORD.findall((text or "").encode().translate(_LOWER))
    ones = list(map(crc32, words))
    # crc32 goes on from the first word's value over the space and the second word.
    twos = list(map(crc32, words[1:], map(crc32, repeat(b" "), ones[:-1])))
    return len(words), np.array(ones + twos, dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket has."""
    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for part in slices(batches, "text"):
            for text in part.column("text").to_pylist():
                counts += np.bincount(features(text, buckets)[1], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])],
                                         names=["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln(share in the target / share in the corpus)), counts plus one."""
    size, corpus, target = len(corpus), corpus.astype(np.float64), target.astype(np.float64)
    ratio = ((target + 1) * (corpus.sum() + size)) / ((corpus + 1) * (target.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def fit(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    return gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))


def weigh(docs: DataFrame, model: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part):
        gain = shared.value
        out = np.zeros((part.num_rows, 3), dtype=np.int64)
        for row, text in zip(out, part.column("text").to_pylist()):
            words, found = features(text, len(gain))
            row[:] = words, len(found), gain[found].sum() // len(found) if len(found) else 0
        return [part.column("doc_id"), part.column("h"),
                *(pa.array(np.ascontiguousarray(c)) for c in out.T)]

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.col("h") + 0.5) / 4294967296.0
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    return map_texts(
        docs.select("doc_id", "text", F.conv(F.substring(digest, 1, 8), 16, 10).cast(
            "bigint").alias("h")),
        f"doc_id {type_of(docs, 'doc_id')}, h bigint, n_words bigint, n_features bigint, "
        "weight bigint", run).select("doc_id", "n_words", "n_features", "weight",
                                     (F.col("weight") + gumbel).alias("score"))


# ---- ranks ----------------------------------------------------------------------------------

def bracket(scores: DataFrame, wanted: int, total: int,
            margin: float = BRACKET) -> tuple[int | None, int | None, int]:
    """(low, high, above): the row of the wanted rank has a score from low to high (None: without
    end), and so many rows have a larger one. Counted exactly; sketches only propose."""
    while True:
        share = 1 - wanted / total
        ends = [share - margin, share + margin]
        found = scores.agg(F.percentile_approx("score", [min(max(e, 0.0), 1.0) for e in ends],
                                               ACCURACY)).first()[0]
        low, high = (q if 0 < e < 1 else None for q, e in zip(found, ends))
        above, upper = scores.agg(
            *(F.count_if(c) for c in (F.lit(False) if high is None else F.col("score") > high,
                                      F.lit(True) if low is None else F.col("score") >= low))
        ).first()
        if above < wanted <= upper:
            return low, high, above
        margin = 8 * margin + 1 / total


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """The rows with ``rank``, 1, 2, 3 ... by falling score, then doc_id.

    Sorted range partitions are written with Spark's running ids: the partition in the upper bits,
    the place in it in the lower 33. Rows before a partition are counted and added. ``spread``
    parts rows that agree in all else.
    """
    order = F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("spread")
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "__at", F.monotonically_increasing_id()), label)
    part = F.shiftright("__at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(
        starts, "part bigint, `__before` bigint"))
    within = F.col("__at").bitwiseAND((1 << 33) - 1)
    return placed.join(starts, part == F.col("part")).withColumn(
        "rank", F.col("__before") + within + 1).drop("__at", "part", "__before")


def resample(docs: DataFrame, model: np.ndarray, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is null where not drawn."""
    made = materialise(weigh(docs, model, seed).withColumn(
        "spread", F.monotonically_increasing_id()), "scored")
    eligible = made.filter(F.col("n_words") >= min_words)
    total = eligible.count()
    wanted = percent * total // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return made.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    low, high, above = bracket(eligible, wanted, total)
    inside = eligible
    if low is not None:
        inside = inside.filter(F.col("score") >= low)
    if high is not None:
        inside = inside.filter(F.col("score") <= high)
    last = numbered(inside.select("doc_id", "score", "spread"), "bracket").filter(
        F.col("rank") == wanted - above).first()
    # Not after the last drawn row, in the order of score, doc_id (nulls last) and spread.
    same = F.col("doc_id").eqNullSafe(F.lit(last["doc_id"]))
    before = F.lit(True) if last["doc_id"] is None else F.col("doc_id") < F.lit(last["doc_id"])
    within = (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (
        F.coalesce(before, F.lit(False)) & ~same | same & (F.col("spread") <= last["spread"])))
    drawn = F.coalesce((F.col("n_words") >= min_words) & within, F.lit(False))
    ranked = numbered(made.filter(drawn).select(*columns, "spread"), "drawn")
    return ranked.select(*columns, "rank").unionByName(
        made.filter(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank")))
