"""Join operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = "trend_month"


def left_join_fanout(
    left: DataFrame,
    right: DataFrame,
    key: str,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Left join that keeps every match and suffixes clashing column names.

    Missing keys match each other, as in a pandas merge.

    It is written as inner join plus anti join. In a left outer join Spark can
    split a skewed left side only; a key owning a large part of the right table
    would be one task. An inner join is split on both sides, and the anti join
    meets the right keys already reduced to one row each. Both joins use the
    left table's shuffle, so it is moved once.
    """
    clashes = (set(left.columns) & set(right.columns)) - {key}
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clashes})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clashes})
    right_key = F.col("__right_key")

    matches = right.withColumnRenamed(key, "__right_key")
    matched = left.join(matches, F.col(key).eqNullSafe(right_key), "inner").drop("__right_key")

    known = right.select(F.col(key).alias("__right_key")).distinct()
    unmatched = left.join(known, F.col(key).eqNullSafe(right_key), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def full_join_on_month(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two monthly tables; the month is merged."""
    return left.join(right, MONTH, "full_outer")


def pair_months_with(months: DataFrame, others: DataFrame, slots: int | None = None) -> DataFrame:
    """Every monthly row next to every row of `others`.

    The result is the product by definition, so what matters is that its rows
    are made by many tasks. `others` (free text keys, any size) is spread over
    `slots` by a hash of its row; the months, at most twelve a year, are copied
    once per slot; an equality join on the slot then pairs them. Neither side
    has to fit in one task, and nothing is broadcast on trust. By default there
    are as many slots as shuffle partitions, so it grows with the cluster.
    """
    slots = slots or int(months.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64(*others.columns), F.lit(slots)).cast("int")
    spread = others.withColumn("__slot", slot)
    copies = months.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return copies.join(spread, "__slot", "inner").drop("__slot")


def lookup_or_keep(df: DataFrame, names: Mapping[str, str], key: str, output: str) -> DataFrame:
    """Add `output`: the name of the key in a fixed list, or the key itself if it has none.

    The list is part of the program, so it is a constant of the plan: no join.
    """
    if not names:
        return df.withColumn(output, F.col(key))
    constants = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    return df.withColumn(output, F.coalesce(F.try_element_at(constants, F.col(key)), F.col(key)))
