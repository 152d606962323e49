"""Text forms of times and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_text(ts: str | Column) -> Column:
    """ISO-8601 text of a time, with microseconds only when there are any."""
    col = F.col(ts) if isinstance(ts, str) else ts
    fraction = F.date_format(col, ".SSSSSS")
    return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(fraction == ".000000", "").otherwise(fraction))


def title_text(label: str | Column) -> Column:
    """Label for display: underscores to spaces, words capitalised."""
    return F.initcap(F.replace(F.col(label) if isinstance(label, str) else label,
                               F.lit("_"), F.lit(" ")))
