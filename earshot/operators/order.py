"""The place of a row in an order over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.session import checkpoint_folder

# Bits of monotonically_increasing_id that number the rows of a partition.
ROW_BITS = 33


def with_place(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """`df` with each row's place in the order, from 1; ties get places in no fixed order.

    No task sees more than its own range: rows are partitioned by range, sorted and
    stored, the rows of each range are counted, and a row's place is the rows of all
    earlier ranges plus its place in its own. What comes to the driver is one number
    a range. Stored, because the numbers hold only for one way the rows were dealt.
    """
    checkpoint_folder(df.sparkSession)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = dealt.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", ROW_BITS).cast("int")
    counts = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, rows = [0], 0
    for number in range(max(counts, default=-1)):
        rows += counts.get(number, 0)
        before.append(rows)
    earlier = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in before]), part + 1)
    own = F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return stored.withColumn(name, earlier + own + 1).drop("__id")
