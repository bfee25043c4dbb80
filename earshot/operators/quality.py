"""Column checks: declared per table, evaluated in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Checks = Mapping[str, Sequence[str]]


class QualityError(ValueError):
    """A table broke one of its declared checks."""


def _violation(column: str, check: str) -> Column:
    if check == "not_null":
        return F.col(column).isNull()
    if check == "positive":  # a missing value is not a violation of this one
        return F.col(column) <= 0
    raise ValueError(f"unknown check: {check}")


def quality_report(df: DataFrame, table: str, checks: Checks) -> DataFrame:
    """One row per check: table_name, column_name, check_name, violations, passed.

    All checks of a table are conditional counts in a single aggregation that
    reads only the checked columns.
    """
    pairs = [(column, check) for column, names in checks.items() for check in names]
    counts = df.agg(
        *[F.count_if(_violation(column, check)).alias(f"{column}:{check}") for column, check in pairs]
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            F.col(f"{column}:{check}").alias("violations"),
            (F.col(f"{column}:{check}") == 0).alias("passed"),
        )
        for column, check in pairs
    ]
    return counts.select(F.inline(F.array(*rows)))


def enforce(*reports: DataFrame) -> None:
    """Raise QualityError naming every failed check (a handful of rows)."""
    report = reduce(DataFrame.unionByName, reports)
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations} rows" for r in failed]
        raise QualityError("; ".join(sorted(lines)))
