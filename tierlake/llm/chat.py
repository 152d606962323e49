"""Chat formatting: conversations that others continue are dropped, the rest are rendered.

Logging often stores a conversation after every turn. A rolling hash over the turns gives each
prefix of a conversation a 128-bit name; a conversation whose own name is that of a shorter prefix
of some other is a snapshot of that one. Names of proper prefixes are made distinct (a first turn
that a third of all conversations share is one row) and an anti-join keeps the conversations that
nobody continues; of equal ones the smallest conv_id stays. What stays is written as one text with
a template of role and content. Column functions only; the turns of a conversation are gathered
once, as they are rendered into one row anyway, and written to the shared folder.

Defined results: rows without conv_id belong to no conversation and are left out; repeated rows
count once; turns are in order of (turn, role, text), nulls first, so equal turn numbers have a
fixed order; a null role is rendered as ``unknown`` and a null text as empty, but neither equals
one that is written so; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.session import materialise

# The template's marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_HASHES = "array<struct<a:bigint,b:bigint>>"


def prefix_hashes(turns: Column) -> Column:
    """The name of each prefix, shortest first: chained hashes of two kinds."""
    def add(done: Column, turn: Column) -> Column:
        last = F.element_at(done, -1)
        content = [F.coalesce(F.concat(F.lit("="), turn[c]), F.lit("null"))
                   for c in ("role", "text")]
        step = F.struct(F.xxhash64(last["a"], *content).alias("a"),
                        F.xxhash64(F.lit(1), last["b"], *reversed(content)).alias("b"))
        return F.array_append(done, step)

    start = F.array(F.struct(F.lit(0).cast("bigint").alias("a"),
                             F.lit(0).cast("bigint").alias("b"))).cast(_HASHES)
    return F.aggregate(turns, start, add, lambda done: F.slice(done, F.lit(2), F.size(done)))


def gathered(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, hashes) of every conversation."""
    own = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    return own.withColumn("hashes", prefix_hashes(F.col("turns")))


def maximal(conversations: DataFrame) -> DataFrame:
    """The conversations that are no prefix of another, one of each group of equal ones."""
    name = F.element_at("hashes", -1)
    named = conversations.select("conv_id", name["a"].alias("a"), name["b"].alias("b"))
    continued = conversations.select(F.explode(F.slice(
        "hashes", F.lit(1), F.size("hashes") - 1)).alias("hash")).select(
        "hash.a", "hash.b").distinct()
    kept = named.join(continued, ["a", "b"], "left_anti").groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"))
    return conversations.join(kept.select("conv_id"), "conv_id", "left_semi")


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda turn: F.concat(
        F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit("\n"),
        F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE + "\n"))), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat) of the conversations that stay."""
    conversations = materialise(gathered(turns), "conversations")
    return maximal(conversations).select(
        "conv_id", F.size("turns").alias("n_turns"), rendered(F.col("turns")).alias("chat"))
