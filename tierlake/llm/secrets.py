"""Secret scan: fixed patterns, and Markov models of random strings against ordinary identifiers.

Base kinds, leftmost and without overlap of their own kind: ``assign`` (a value of 8 characters or
more given to a password, token, key ...), ``access`` (AKIA keys of 16 or more) and ``hex`` (32 or
more digits). The method adds ``markov``: runs of CANDIDATE_LENGTH or more key characters that no
base span overlaps and whose characters follow each other as in random strings rather than as in
ordinary identifiers: the log-likelihood ratio of two first-order models over the whole run is at
least ``min_ratio``.

Both models are trained from labelled samples of the table itself: values of base spans are random
(of at most ``sample`` documents that have one), words of documents without base spans are
ordinary (of at most ``sample``), each with the fixed names below; documents are taken by a hash of
the id. Transitions are counted in Spark; the model that comes back has one number a pair of key
characters. Scanning covers all texts as a whole, with column functions only.

A pattern's matches and the pieces between them alternate, so lengths add up to positions (code
points). A cheap test for a necessary substring goes before each pattern.

Defined results: a null text is scanned as empty; no spans give an empty list and the hash of an
empty string; rows are independent, so ids may be null or repeated. Without labelled values the
random model is uniform. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.session import materialise

# The base patterns.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH = 8
ACCESS, ACCESS_LENGTH = "AKIA[A-Z0-9]+", 16
HEX_LENGTH = 32
HEX = "[0-9a-f]{%d,}" % HEX_LENGTH  # a run of digits is one match, so short ones can be left out

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE_LENGTH = 20
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % CANDIDATE_LENGTH
# Ordinary names, so that code is known even where the table has none.
ORDINARY = ("getUserNameFromRequest set_default_configuration max_retry_attempts "
            "applicationContextFactory http_response_headers XMLHttpRequestBuilder "
            "is_authenticated_user database-connection-pool com/example/service/Handler "
            "parseJsonDocument DEFAULT_TIMEOUT_SECONDS numberOfElements training_data_pipeline "
            "src/main/resources/templates __init_subclass__ convert-to-lower-case "
            "internationalization ConcurrentHashMapIterator file_system_provider "
            "https-redirect-middleware calculateTotalAmount user_profile_picture_url").split()

#: A row of the models is drawn to the single characters with the weight of so many pairs.
DRAWN = 10.0

KINDS = ("assign", "access", "hex", "markov")
_SPAN = "array<struct<start:int,end:int,value:string>>"
#: Items of which results are gathered at once.
BLOCK = 256


def located(text: Column, pattern: str, least: int, group: int = 0) -> Column:
    """Spans (start, end, value) of the matches whose group has ``least`` characters."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    parts = F.arrays_zip(between.alias("between"), matches.alias("match"), values.alias("value"))

    def place(at: Column, part: Column) -> tuple[Column, Column]:
        start = at + F.length(part["between"])
        end = start + F.length(part["match"])
        return end, F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value"))

    return F.filter(running(parts, F.lit(0), _SPAN, place),
                    lambda span: F.length(span["value"]) >= least)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: what stands inside a lambda is evaluated for each
    element, its variables are not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, state: Column, out_type: str,
            step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """An array of what ``step(state, item)``, which gives the next state too, makes of each item.

    Appending copies an array, so results are gathered in blocks of BLOCK items: n items take
    n * BLOCK + (n / BLOCK)^2 copies instead of n^2.
    """
    def add(carry: Column, item: Column) -> Column:
        after, made = step(carry["state"], item)
        return F.struct(after.alias("state"), F.array_append(carry["out"], made).alias("out"))

    def block(carry: Column, part: Column) -> Column:
        begin = F.struct(carry["state"].alias("state"), F.array().cast(out_type).alias("out"))
        return _with(F.aggregate(part, begin, add), lambda done: F.struct(
            done["state"].alias("state"),
            F.array_append(carry["blocks"], done["out"]).alias("blocks")))

    def whole(all_items: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_items) - 1, F.lit(0)) / BLOCK).cast("int")
        begin = F.struct(state.alias("state"),
                         F.array().cast(f"array<{out_type}>").alias("blocks"))
        return F.aggregate(
            F.sequence(F.lit(0), last), begin,
            lambda carry, n: block(carry, F.slice(all_items, n * BLOCK + 1, F.lit(BLOCK))),
            lambda carry: F.flatten(carry["blocks"]))

    return _with(items, whole)


def apart(spans: Column, others: Column) -> Column:
    """The spans that share no character with any of the others, by two passes over all in order."""
    def listed_as(array: Column, own: bool) -> Column:
        return F.transform(array, lambda s: F.struct(
            s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"),
            s["value"].alias("value"), F.lit(True).alias("clear")))

    def out(span: Column, clear: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["own"].alias("own"),
                        span["end"].alias("end"), span["value"].alias("value"),
                        (span["clear"] & clear).alias("clear"))

    def after_end(reached: Column, span: Column) -> tuple[Column, Column]:
        return (F.when(span["own"], reached).otherwise(F.greatest(reached, span["end"])),
                out(span, reached <= span["start"]))

    def before_start(following: Column, span: Column) -> tuple[Column, Column]:
        return (F.when(span["own"], following).otherwise(span["start"]),
                out(span, following >= span["end"]))

    kind = "array<struct<start:int,own:boolean,end:int,value:string,clear:boolean>>"
    ordered = F.array_sort(F.concat(listed_as(others, False), listed_as(spans, True)))
    forward = running(ordered, F.lit(0), kind, after_end)
    both = running(F.reverse(forward), F.lit(2 ** 31 - 1), kind, before_start)
    return F.transform(
        F.reverse(F.filter(both, lambda s: s["own"] & s["clear"])),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                           s["value"].alias("value")))


def _none() -> Column:
    return F.array().cast(_SPAN)


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, assign, access, hex): the spans of each base kind; null texts as empty."""
    text = F.col("text")
    lower = F.lower(text)
    named = reduce(Column.__or__, (F.contains(lower, F.lit(w)) for w in ASSIGN_WORDS))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text",
        F.when(named, located(text, ASSIGN, ASSIGN_LENGTH, 2)).otherwise(_none()).alias("assign"),
        F.when(F.contains(text, F.lit("AKIA")), located(text, ACCESS, ACCESS_LENGTH))
        .otherwise(_none()).alias("access"),
        F.when(F.rlike(text, F.lit(HEX)), located(text, HEX, HEX_LENGTH))
        .otherwise(_none()).alias("hex"))


def _codes(value: Column) -> Column:
    """1 .. of each character in the alphabet, 0 for others."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(value: Column) -> Column:
    """A number for each two characters that follow each other.

    Both sides are arrays outside the lambda: what stands inside is evaluated for each element.
    """
    codes = _codes(value)
    last = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), last), F.slice(codes, F.lit(2), last),
                      lambda code, after: code * (len(ALPHABET) + 1) + after)


def _first(rows: DataFrame, sample: int) -> DataFrame:
    """The rows of at most so many ids, by a hash of the id."""
    return (rows.filter(F.col("doc_id").isNotNull())
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def train(docs: DataFrame, sample: int = 1_000) -> list[float]:
    """The log-likelihood ratio of each pair of characters, random against ordinary."""
    labelled = materialise(base_spans(docs).select("doc_id", F.transform(
        F.concat("assign", "access", "hex"), lambda span: span["value"]).alias("values")), "labelled")
    has = F.size("values") > 0
    random = _first(labelled.filter(has), sample).select(
        F.lit(1).alias("label"), F.explode("values").alias("value"))
    without = _first(labelled.filter(~has).select("doc_id"), sample)
    plain = docs.select("doc_id", "text").join(
        F.broadcast(without.distinct()), "doc_id", "left_semi").select(
        F.lit(0).alias("label"), F.explode(F.regexp_extract_all(
            "text", F.lit("[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("value")).filter(
        F.length("value") < CANDIDATE_LENGTH)
    names = docs.sparkSession.createDataFrame([(0, n) for n in ORDINARY for _ in range(20)],
                                              "label int, value string")
    counted = (random.unionByName(plain).unionByName(names)
               .select("label", F.explode(_pairs(F.col("value"))).alias("pair"))
               .groupBy("label", "pair").count().collect())
    size = len(ALPHABET) + 1
    counts = [[0] * (size * size) for _ in range(2)]
    for row in counted:
        counts[row["label"]][row["pair"]] += row["count"]
    ordinary, random_ = (_log_probabilities(c, size) for c in counts)
    return [r - o for r, o in zip(random_, ordinary)]


def _log_probabilities(counts: list[int], size: int) -> list[float]:
    """ln p(second | first) of all pairs, drawn to the frequency of the second alone."""
    singles = [1 + sum(counts[second::size]) for second in range(size)]
    total, out = sum(singles), []
    for first in range(size):
        row = counts[first * size:(first + 1) * size]
        out += [math.log((n + DRAWN * single / total) / (sum(row) + DRAWN))
                for n, single in zip(row, singles)]
    return out


def ratio_of(value: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a string."""
    numbers = F.split(F.lit(",".join(f"{r:.5f}" for r in model)), ",").cast("array<double>")
    return F.aggregate(_pairs(value), F.lit(0.0), lambda total, pair: total + F.get(numbers, pair))


def scan(docs: DataFrame, model: list[float], min_ratio: float = 12.0) -> DataFrame:
    """(doc_id, assign, access, hex, markov): all spans as (start, end, value) by kind."""
    text = F.col("text")
    found = base_spans(docs).withColumn(
        "markov", F.when(F.rlike(text, F.lit(CANDIDATE)),
                         located(text, CANDIDATE, CANDIDATE_LENGTH)).otherwise(_none()))
    base = F.concat("assign", "access", "hex")
    alone = F.when(F.size("markov") > 0, apart(F.col("markov"), base)).otherwise(_none())
    return found.select("doc_id", "assign", "access", "hex", F.filter(
        alone, lambda span: ratio_of(span["value"], model) >= min_ratio).alias("markov"))


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some kinds, by start, then by kind as listed."""
    def lines(kind: str, order: int) -> Column:
        return F.transform(kind, lambda span: F.struct(
            span["start"].alias("start"), F.lit(order).alias("order"), F.concat_ws(
                ":", F.lit(kind), span["start"].cast("string"), span["end"].cast("string"))
            .alias("text")))

    rows = F.concat(*(lines(kind, order) for order, kind in enumerate(kinds)))
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["text"]), ",")
