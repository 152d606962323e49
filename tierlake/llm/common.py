"""What the operators share: tables, the learn / held-out split, Arrow passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from tierlake.session import remove_tree, scratch_path, tree_bytes

#: Texts of one slice of an Arrow batch may have so many characters before results are sent on.
SLICE_CHARS = 4_000_000
#: Spark ends an Arrow batch at so many bytes (its default, 64 MB or 10,000 rows, is held several
#: times over in each task: built and grown in the JVM, read in Python).
BATCH_BYTES = 4_000_000
_BATCH_OPTION = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A key that more than this share of all rows have is joined by broadcast; there are at most
#: 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3 is 1; false for a null id, which is not learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def may_learn(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).isNotNull() & ~is_held_out(doc_id)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def slices(batches: Iterator[pa.RecordBatch], column: str,
           most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice have a bounded size (or are one text)."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.utf8_length(batch.column(column)).to_pylist()
        for row, length in enumerate(lengths):
            if size and size + (length or 0) > most:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length or 0
        if start < len(lengths):
            yield batch.slice(start)


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator],
               schema: StructType | str) -> DataFrame:
    """mapInArrow over batches of bounded size, or as the caller's session has it."""
    if df.sparkSession.conf.get(_BATCH_OPTION, None) is None:
        df.sparkSession.conf.set(_BATCH_OPTION, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def map_texts(df: DataFrame, schema: StructType | str,
              function: Callable[[pa.RecordBatch], list[pa.Array]], text: str = "text",
              most: int = SLICE_CHARS) -> DataFrame:
    """Apply a function of Arrow slices; it returns the arrays of the schema's columns."""
    def run(batches):
        for part in slices(batches, text, most):
            columns = function(part)
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    plain = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    return in_batches(df, run, plain).toDF(*(f.name for f in fields))


class Stored:
    """Tables of intermediate results in the shared folder, removed when no step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, {}

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        made = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(made)] = (path, made)
        return made

    def bytes_of(self, made: DataFrame) -> int:
        path, _ = self._paths[id(made)]
        return tree_bytes(self.spark, path)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables; what was made from them must be stored itself."""
        for made in tables:
            path, _ = self._paths.pop(id(made))
            remove_tree(self.spark, path)


def free_name(base: str, columns: list[str]) -> str:
    """A name that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def place_of(docs: DataFrame) -> Column:
    """What orders documents and tells them apart: doc_id, nulls first, then a hash of the text.

    One number for whole-number ids (65 bits of id, 60 of hash), which aggregates by hash, and a
    struct for others.
    """
    named = F.xxhash64("text")
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return F.struct("doc_id", named.alias("hash"))
    number = F.coalesce(F.col("doc_id").cast("decimal(20,0)"),
                        F.lit(str(-(2 ** 63) - 1)).cast("decimal(20,0)"))
    return (number * F.lit(2 ** 60).cast("decimal(19,0)")
            + F.shiftrightunsigned(named, 4).cast("decimal(19,0)")).cast("decimal(38,0)")


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with a table of one row a key that has the number ``n`` of its rows.

    Rows of keys with more than HOT_SHARE of them all don't meet in a task: those keys, a bounded
    number, are broadcast. Both tables are read twice, so they should be stored.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > max(total * HOT_SHARE, 1000)
    hot = counted.filter(is_hot)
    cold = rows.join(counted.filter(~is_hot), keys)
    if hot.isEmpty():
        return cold
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


#: Tables of so many bytes at most, by the size of their stored files, are broadcast to join texts.
SMALL_BYTES = 32_000_000


def join_to_texts(texts: DataFrame, found: DataFrame, on: list[str] | Column, how: str,
                  stored: Stored) -> DataFrame:
    """Join whole texts with a stored table of one row a key.

    Texts are the bulk of a corpus, so they are shuffled only if the table's files have more than
    SMALL_BYTES (AQE would find out after the texts are written to its shuffle).
    """
    small = stored.bytes_of(found) <= SMALL_BYTES
    return texts.join(F.broadcast(found) if small else found, on, how)
