"""Sentiment of text from a word list.

A text is split into lower-case words, each word is looked up in the word list, and the sum s of
the valences found becomes s / sqrt(s * s + 15) (the published normalisation of Hutto & Gilbert,
2014). There are no rules for negation, emphasis or punctuation, so scores differ from those of a
rule-based library; the label cuts are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.functions.bands import sentiment_label

NORMALISER = 15

# Our own word list: five strengths, a handful of words each.
VALENCE = {
    3: "amazing awesome brilliant excellent exceptional fantastic flawless outstanding perfect "
       "superb wonderful",
    2: "beautiful best delighted durable elegant enjoy great happy impressed love pleased "
       "recommend reliable satisfied worth",
    1: "comfortable fast fine fresh good helpful improved nice okay quick solid sturdy thanks "
       "useful",
    -1: "average bland cheap delay difficult late noisy overpriced poor slow weak wrong",
    -2: "annoying bad boring broken damaged defective disappointed fake faulty refund sad stupid "
        "ugly useless",
    -3: "awful disgusting fraud garbage hate horrible idiot pathetic scam terrible trash "
        "worst worthless",
}


def lexicon(spark: SparkSession) -> DataFrame:
    """The word list as a table of ``word, valence``."""
    rows = [(word, valence) for valence, words in VALENCE.items() for word in words.split()]
    return spark.createDataFrame(rows, "word string, valence int")


def words(text: str | Column) -> Column:
    """Lower-case runs of Latin letters."""
    return F.split(F.lower(text), "[^a-z]+")


def score_sentiment(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, hits, sentiment_score, sentiment_label`` for every row; a text without a listed
    word, or a null text, scores 0.

    Words meet the word list in a broadcast join (the list is a constant of this module). Only
    the key travels with the words, and the words of one text are added up in the task that
    split it, so the shuffle carries one row per text.
    """
    tokens = df.select(key, F.explode_outer(words(text)).alias("word"))
    listed = F.broadcast(lexicon(df.sparkSession))
    sums = tokens.join(listed, "word", "left").groupBy(key).agg(
        F.count("valence").alias("hits"),
        F.coalesce(F.sum("valence"), F.lit(0).cast("long")).alias("_s"))
    s = F.col("_s")
    return sums.select(
        key, "hits",
        F.round(s / F.sqrt(s * s + NORMALISER), 4).alias("sentiment_score"),
    ).withColumn("sentiment_label", sentiment_label())
