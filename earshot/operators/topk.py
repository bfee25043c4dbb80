"""Ranked reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_ascending(df: DataFrame, by: str, tie: str, n: int = 15) -> DataFrame:
    """The n largest rows by `by`, shown smallest first, NULLs at the end.

    A missing value counts as the largest, as when a pandas frame is sorted and
    its tail taken. Equal values are ordered by `tie`. Spark keeps only n rows
    per task for the limit.
    """
    best = df.orderBy(F.col(by).desc_nulls_first(), F.col(tie).desc()).limit(n)
    return best.orderBy(F.col(by).asc_nulls_last(), F.col(tie).asc())
