"""Grouping operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.numbers import INPUT_DIGITS, rounded_quotient, scaled_long

# ---- measures that add up ------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """An aggregate made of sums: per row the bigints that are added, and the result from their sums.

    Sums of whole numbers are the same in any order, so a measure does not depend on
    how rows were partitioned. A sum beyond a bigint within one value of a counted
    column raises; totals of a group are added as decimals.
    """

    name: str
    terms: tuple[Column, ...]
    result: object  # a function of the summed columns


def row_count(name: str) -> Measure:
    return Measure(name, (F.lit(1).cast("bigint"),), lambda n: n.cast("bigint"))


def count_where(condition: Column, name: str) -> Measure:
    """Rows for which the condition is true."""
    return Measure(name, (F.when(condition, 1).otherwise(0).cast("bigint"),), lambda n: n.cast("bigint"))


def share_where(condition: Column, digits: int, name: str) -> Measure:
    """Share of all rows for which the condition is true, rounded."""
    terms = F.when(condition, 1).otherwise(0).cast("bigint"), F.lit(1).cast("bigint")
    return Measure(name, terms, lambda part, whole: rounded_quotient(part, whole, digits))


def total(column: str, name: str) -> Measure:
    """Sum of a bigint column; NULL where it has no value."""
    return Measure(name, (F.col(column).cast("bigint"),), lambda n: n.cast("bigint"))


def mean(column: str, digits: int, name: str, divisor: int = 1, input_digits: int = INPUT_DIGITS) -> Measure:
    """Mean of the values that are there, divided by `divisor`, rounded once to `digits`.

    Values are taken to `input_digits` digits and added as whole numbers.
    """
    scaled = scaled_long(F.col(column), input_digits)
    terms = scaled, scaled.isNotNull().cast("bigint")
    unit = 10**input_digits * divisor
    return Measure(name, terms, lambda part, whole: rounded_quotient(part, whole, digits, unit))


def aggregate_with_distincts(
    df: DataFrame,
    keys: Mapping[str, Column],
    measures: Sequence[Measure],
    distincts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group by `keys`, with measures and exact distinct counts, in one reading of the input.

    `keys` maps output names to expressions, `distincts` maps output names to the
    column counted; the one with the fewest values is best given first.

    A row becomes one row (keys, tag, value) per counted column; the terms of the
    measures ride on those of the first. They are added up by keys, tag and value
    together: in the map tasks already, so a value repeated many times (a track on
    every day of a month) leaves each of them once, and over all tasks, so a group
    that holds most of the rows is spread. What is left per value is counted, and the
    sums added up. `countDistinct` in one `agg` would carry the sums with the values
    of every counted column and with all pairs of them; here they are missing (all
    zero bytes) on all but the first.
    """
    named_keys = [expr.alias(name) for name, expr in keys.items()]
    terms = {f"__{i}_{j}": term for i, m in enumerate(measures) for j, term in enumerate(m.terms)}
    named_terms = [term.alias(name) for name, term in terms.items()]
    if not distincts:
        summed = df.select(*named_keys, *named_terms).groupBy(*keys).agg(
            *[F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in terms])
        return summed.select(*keys, *_results(measures))
    kinds = df.schema
    # one column per counted column, so that each keeps its type
    values = [f"__value_{name}" for name in distincts]
    nothing = F.lit(None).cast("bigint")
    tagged = F.array(*[
        F.struct(F.lit(tag).alias("__tag"), *[
            (F.col(f"__{own}") if other == tag else F.lit(None).cast(kinds[column].dataType)).alias(f"__value_{own}")
            for other, (own, column) in enumerate(distincts.items())
        ], *[(F.col(f"__term{name}") if tag == 0 else nothing).alias(name) for name in terms])
        for tag in range(len(distincts))
    ])
    wide = df.select(
        *named_keys, *[F.col(column).alias(f"__{own}") for own, column in distincts.items()],
        *[term.alias(f"__term{name}") for name, term in terms.items()],
    )
    by_value = wide.select(*keys, F.inline(tagged)).groupBy(*keys, "__tag", *values).agg(
        *[F.sum(name).alias(name) for name in terms])
    summed = by_value.groupBy(*keys).agg(
        *[F.count(value).alias(name) for value, name in zip(values, distincts)],
        *[F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in terms],
    )
    return summed.select(*keys, *distincts, *_results(measures))


def _results(measures: Sequence[Measure]) -> list[Column]:
    return [
        m.result(*[F.col(f"__{i}_{j}") for j in range(len(m.terms))]).alias(m.name) for i, m in enumerate(measures)
    ]


# ---- other groupings -----------------------------------------------------------


def value_at_largest(value: str, order: str) -> Column:
    """Aggregate: `value` of the row with the largest `order`.

    A NULL order ranks last; ties go to the largest value, so the answer does
    not depend on row order.
    """
    return F.max_by(F.col(value), F.struct(F.col(order), F.col(value)))


def group_known(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Group by one key, leaving out rows without a key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of one column."""
    return df.select(column).na.drop().distinct()


def one_row_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, for columns that are the same on all rows of a key."""
    return df.select(key, *columns).dropDuplicates([key])


def one_row_of_totals(parts: Sequence[tuple[DataFrame, Sequence[Column]]]) -> DataFrame:
    """Global aggregates over several tables as one row; each table is aggregated once.

    The tables' rows are stacked and folded, so no cross join is needed.
    """
    rows = [df.agg(*totals) for df, totals in parts]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
