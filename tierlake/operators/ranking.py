"""percent_rank over a whole table without putting the table into one task.

``percent_rank().over(Window.orderBy(...))`` sends every row to a single task. A row's rank only
depends on how many rows have a larger value, so we count rows per distinct value and add the
counts up from the largest value down. The running sum is done in three levels that split the
value (an amount in cents) into groups of 2^18 neighbouring values, and those again into groups
of 2^18. A group can therefore never hold more than 2^18 rows, however the values are spread,
and no sampling or driver round trip is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.session import materialise

_BITS = 18
# Values that hold more than this share of all rows are joined by broadcast; there can be at
# most 1 / share of them.
_HOT_SHARE = 1 / 1024


def cents(amount: str | Column) -> Column:
    """A decimal(16,2) amount as a whole number of cents (fits 54 bits)."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return (col * 100).cast("long")


def _larger_in_group(group: list[str], order: str, count: str) -> Column:
    """Rows counted by larger values of the same group: a running sum that leaves out this row."""
    window = (Window.partitionBy(*group).orderBy(F.col(order).desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum(count).over(window), F.lit(0).cast("long"))


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """``value, n``: rows per distinct value, null included. Stored, as it is read repeatedly
    where the rows themselves are read once."""
    return materialise(df.groupBy(value).agg(F.count("*").alias("n")), "value-counts")


def count_larger(counts: DataFrame, value: str) -> DataFrame:
    """``value, n, n_larger``: per distinct integer value, its rows and the rows above it.

    A null value counts as smaller than all others.
    """
    lo = (counts.filter(F.col(value).isNotNull())
          .withColumn("_mid", F.shiftright(value, _BITS))
          .withColumn("_hi", F.shiftright(value, 2 * _BITS)))
    mid = lo.groupBy("_hi", "_mid").agg(F.sum("n").alias("_mid_n"))
    hi = mid.groupBy("_hi").agg(F.sum("_mid_n").alias("_hi_n"))
    # At most 2^19 rows (54-bit values cut by 36 bits, both signs), so one task may hold them.
    hi = hi.select("_hi", _larger_in_group([], "_hi", "_hi_n").alias("_above_hi"))
    mid = (mid.withColumn("_above_mid", _larger_in_group(["_hi"], "_mid", "_mid_n"))
           .join(hi, "_hi")
           .select("_mid", (F.col("_above_hi") + F.col("_above_mid")).alias("_above")))
    valued = (lo.withColumn("_above_lo", _larger_in_group(["_mid"], value, "n"))
              .join(mid, "_mid")
              .select(value, "n", (F.col("_above") + F.col("_above_lo")).alias("n_larger")))
    all_valued = counts.filter(F.col(value).isNotNull()).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n_larger"))
    unvalued = counts.filter(F.col(value).isNull()).crossJoin(F.broadcast(all_valued))
    return valued.unionByName(unvalued)


def _percent(n_larger: Column, total: Column) -> Column:
    """percent_rank from the number of larger rows; 0 in a table of one row."""
    return F.when(total > 1, n_larger / (total - 1)).otherwise(0.0)


def _value_ranks(df: DataFrame, value: str, output: str) -> DataFrame:
    """``value, n, _total, output``: the percent_rank of each distinct value."""
    counts = value_counts(df, value)
    total = F.broadcast(counts.agg(F.sum("n").alias("_total")))
    return count_larger(counts, value).crossJoin(total).withColumn(
        output, _percent(F.col("n_larger"), F.col("_total")))


def top_share_cutoff(df: DataFrame, value: str, share: float) -> DataFrame:
    """One row, ``cutoff, null_is_top``: the smallest value whose descending percent_rank is
    within a share, and whether rows without a value, which rank last, are within it too."""
    ranks = _value_ranks(df, value, "_rank")
    return ranks.filter(F.col("_rank") <= share).agg(
        F.min(value).alias("cutoff"),
        F.coalesce(F.bool_or(F.col(value).isNull()), F.lit(False)).alias("null_is_top"))


def percent_rank_desc(df: DataFrame, value: str, output: str) -> DataFrame:
    """Add the percent_rank of an integer column over all rows, largest value first.

    Equal to the window function for rows with a value; a null value ranks after all others,
    as a window ordered ``desc`` (nulls last) has it.

    Rows meet the ranks of their values in a join. Null, and values shared by very many rows,
    are joined by broadcast (there are at most ``1 / _HOT_SHARE`` such values), so no task
    receives all the rows of one value; the others are joined on the value.
    """
    ranks = _value_ranks(df, value, output).select(
        F.col(value).alias("_value"), output,
        (F.col(value).isNull() | (F.col("n") > F.col("_total") * _HOT_SHARE)).alias("_hot"))
    hot = ranks.filter("_hot").select("_value", F.col(output).alias("_hot_rank"))
    cold = ranks.filter("not _hot").select("_value", output)

    tagged = df.join(F.broadcast(hot), F.col(value).eqNullSafe(F.col("_value")), "left").drop(
        "_value")
    from_hot = tagged.filter(F.col("_hot_rank").isNotNull()).withColumnRenamed(
        "_hot_rank", output)
    from_cold = (tagged.filter(F.col("_hot_rank").isNull()).drop("_hot_rank")
                 .join(cold, F.col(value) == F.col("_value")).drop("_value"))
    return from_hot.unionByName(from_cold)
