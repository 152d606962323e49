"""Quality rules judged by host.

Every text is measured on its own; a text fails the base rule if it is short or repeats itself.
A host (the column named by ``host``, such as source or a page's domain) fails as a whole if too
many of its texts do. A host's rate is shrunk by a beta prior whose mean and strength come from
all hosts (method of moments on the rates, each weighted by its number of texts), so a host with
few texts is judged mostly by what hosts are like:

    shrunk = (fails + a) / (texts + a + b)

Texts of a host are not kept if its shrunk rate is over ``max_rate``, or if its rate is clearly
above what is usual: the posterior's mean lies more than ``certainty`` of its standard deviations
above ``factor`` times the rate of all texts. The prior is one row; host verdicts are joined back with ``SALTS`` copies of each host's row, so that a host with a third of
all texts is dealt over many tasks. Measures are taken once and stored in the shared folder.

Defined results: a null or empty text has no words and fails; a null host is no host: its texts
count in no rate and only the base rule decides on them; ids may be null or repeated, every row
gets its own result; an empty table gives an empty result. Columns other than the id, text and
host are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.common import map_texts, type_of
from tierlake.session import materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SALTS = 32
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str]) -> int:
    """How many words lie in a window of eight words that the text has twice or more.

    Windows get exact numbers by doubling: pairs of words, pairs of pairs, pairs of those.
    """
    if len(words) <= WINDOW:
        return 0
    number: dict[str, int] = {}
    names = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    width = 1
    while width < WINDOW:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width *= 2
    repeated = np.bincount(names)[names] > 1
    if not repeated.any():
        return 0
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, np.flatnonzero(repeated), 1)
    np.add.at(steps, np.flatnonzero(repeated) + WINDOW, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(lines) - len(set(lines))


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of MEASURES."""
    text = text or ""
    words = WORD.findall(text)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in SYMBOLS),
            repeated_lines(text), repeated_words(words))


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, MEASURES, base_failed) of every text."""
    def run(part):
        columns = list(zip(*map(measure, part.column("text").to_pylist()))) or [()] * 5
        return [part.column("doc_id"), part.column("host"),
                *(pa.array(c, pa.int64()) for c in columns)]

    wide = ", ".join(f"{m} bigint" for m in MEASURES)
    return map_texts(docs.select("doc_id", F.col(host).cast("string").alias("host"), "text"),
                     f"doc_id {type_of(docs, 'doc_id')}, host string, {wide}", run).withColumn(
        "base_failed", (F.col("n_words") < 20)
        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, texts, fails, shrunk, spread, usual): failure rates drawn towards the mean of all
    hosts, with the posterior's standard deviation; the failure rate of all texts."""
    hosts = (measured.filter(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count("*").alias("texts"),
                  F.sum(F.col("base_failed").cast("bigint")).alias("fails")))
    rate, n = F.col("fails") / F.col("texts"), F.col("texts")
    sums = hosts.agg(F.sum("fails").alias("f"), F.sum(n).alias("n"), F.count("*").alias("k"),
                     F.sum(n * rate * rate).alias("square"), F.sum(n * n).alias("nn"))
    mean = F.col("f") / F.col("n")
    # Variance of the hosts' rates beyond that of counting, by the weighted moments.
    between = F.greatest(
        (F.col("square") - F.col("n") * mean * mean - (F.col("k") - 1) * mean * (1 - mean))
        / F.nullif(F.col("n") - F.col("nn") / F.col("n"), F.lit(0.0)),
        F.lit(1e-6))
    strength = F.least(F.greatest(F.coalesce(mean * (1 - mean) / between - 1, F.lit(1.0)),
                                  F.lit(1.0)), F.lit(1e6))
    prior = sums.select(mean.alias("mean"), strength.alias("strength"))
    weight = F.col("texts") + F.col("strength")
    shrunk = (F.col("fails") + F.col("mean") * F.col("strength")) / weight
    return hosts.crossJoin(F.broadcast(prior)).select(
        "host", "texts", "fails", shrunk.alias("shrunk"),
        F.sqrt(shrunk * (1 - shrunk) / (weight + 1)).alias("spread"), F.col("mean").alias("usual"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5, factor: float = 2.0,
          certainty: float = 4.0) -> DataFrame:
    """(doc_id, MEASURES, base_failed, host_rate, kept) of every text."""
    measured = materialise(measures(docs, host), "quality")
    verdicts = host_rates(measured).select(
        "host", F.col("shrunk").alias("host_rate"),
        ((F.col("shrunk") > max_rate)
         | (F.col("shrunk") - certainty * F.col("spread") > factor * F.col("usual"))).alias("bad"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"),
                                                F.lit(SALTS)).cast("int"))
    return salted.join(verdicts, ["host", "salt"], "left").select(
        "doc_id", *MEASURES, "base_failed", "host_rate",
        (~F.col("base_failed") & ~F.coalesce(F.col("bad"), F.lit(False))).alias("kept"))
