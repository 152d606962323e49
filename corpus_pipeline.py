"""A training corpus from documents: five stages, each written as Parquet before the next reads it.

1. toxicity: documents that the grammar, fitted to the labels of those documents, rejects go.
2. line_dedup: later copies of repeated runs of lines are deleted from the texts; a document of
   which nothing is left is a copy as a whole and goes.
3. jaccard_join: of each class of near copies the first document stays.
4. decontamination: documents that contain a benchmark item go.
5. sentencepiece: every text that is left is encoded; ids and what they decode to are returned.

Stages 1 to 4 return the columns of their input. Null and empty texts pass all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.llm import decontamination, jaccard_join, line_dedup, sentencepiece_bpe, toxicity
from tierlake.llm.common import table
from tierlake.llm.queries import pieces_path
from tierlake.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_DELETED = "__deleted_lines"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = line_dedup.delete_copies(docs, count_as=_DELETED)
    shorter = F.col(_DELETED) > 0
    made = made.filter(~shorter | (F.trim(F.translate("text", "\n\r\t", "")) != "")
                       | F.col("text").isNull())
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made = made.withColumn("n_chars", F.when(shorter, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return made.drop(_DELETED)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = sentencepiece_bpe.encode_and_decode(docs, pieces_path())
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies), ("decontamination", drop_leaks),
    ("sentencepiece", encode)]

#: No SQL: the stages train models and walk automata; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
