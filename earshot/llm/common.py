"""Helpers shared by the operators: Arrow batches, stored intermediates, rows as structs."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from earshot.session import checkpoint_folder

# An Arrow batch that reaches Python is cut into pieces of about this many
# bytes, so that the memory of a task follows the longest text, not the batch.
PIECE_BYTES = 8 << 20
BATCH_ROWS = 1000


def whole(column: str) -> "F.Column":
    """A column by its exact name, also when it holds dots."""
    return F.col(f"`{column}`")


def pieces(batch: pa.RecordBatch, by: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts in column number `by` hold about PIECE_BYTES each."""
    if batch.num_rows <= 1 or batch.column(by).nbytes <= PIECE_BYTES:
        yield batch
        return
    ends = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(by)).to_numpy(zero_copy_only=False)))
    cuts = np.flatnonzero(np.diff(ends // PIECE_BYTES)) + 1
    for start, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
        yield batch.slice(start, end - start)


# What a Python worker keeps for later tasks, by name: the stage it was made in, and the value.
_KEPT: dict[object, tuple[int, object]] = {}


def release() -> int:
    """Drop what was kept in other stages than this one, as a worker outlives them; the number of this stage."""
    task = TaskContext.get()
    stage = task.stageId() if task else -1
    for name in [name for name, (own, _) in _KEPT.items() if own != stage]:
        del _KEPT[name]
    return stage


def kept_in_stage(name: object, make: Callable[[], object]) -> object:
    """`make()`, or what an earlier task of the same stage made under that name in this worker."""
    stage = release()
    if name not in _KEPT:
        _KEPT[name] = stage, make()
    return _KEPT[name][1]


def with_results(
    df: DataFrame,
    text: str,
    results: str,
    compute: Callable[[list[str | None]], list],
    carry: list[str] | None = None,
    arrow: bool = False,
) -> DataFrame:
    """Columns computed from a text column in Python, next to the columns in `carry` (all by default).

    `results` is a DDL list of the new columns; `compute` takes the texts of some
    rows (as an Arrow array with `arrow`) and returns one list or Arrow array per new
    column. A new column replaces a carried one of the same name.
    """
    added = T._parse_datatype_string(results)
    taken = {field.name.lower() for field in added.fields}
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() not in taken]
    read = kept if text in kept else [*kept, text]
    place = read.index(text)
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        types = [to_arrow_type(field.dataType) for field in added.fields]
        names = kept + [field.name for field in added.fields]
        for batch in batches:
            for piece in pieces(batch, place):
                texts = piece.column(place)
                values = compute(texts if arrow else texts.to_pylist())
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types)]
                yield pa.RecordBatch.from_arrays(piece.columns[: len(kept)] + arrays, names=names)

    return df.select(*map(whole, read)).mapInArrow(run, schema)


def numbered(df: DataFrame) -> DataFrame:
    """The same columns named c0, c1, ..., so that no name can clash with a working column."""
    return df.select(*(whole(c).alias(f"c{i}") for i, c in enumerate(df.columns)))


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself if visible Latin-1, else the next from U+0100 on."""
    letters, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows written to the shared checkpoint folder, read from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few_rows(spark: SparkSession) -> None:
    """Texts are long: fewer rows than usual make an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    few_rows(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Rows that may be broadcast, and rows of one key that stay in one part of a join.
SMALL_ROWS = 1 << 20
KEY_ROWS = 4096


def join_small(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with rows of a few numbers, stored: sent to every executor if counted to be few, else shuffled.

    `big` holds long texts or lists; a shuffle of it is worth avoiding where that is safe.
    """
    return big.join(F.broadcast(small) if small.count() <= SMALL_ROWS else small, on)


def join_spread(
    left: DataFrame, right: DataFrame, on: list[str], rows: int = KEY_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Inner join with one row a key on the right, whatever the rows of a key on the left.

    A key with more than `rows` rows is cut into parts of about so many; its row on
    the right goes to each part. The rows of a key are counted in `counted`, a stored
    table with the keys of `left` (by default `left` itself).
    """
    keys = left if counted is None else counted
    parts = keys.groupBy(*on).agg(F.ceil(F.count("*") / rows).cast("int").alias("__parts")).filter("__parts > 1")
    parts = reliable(parts)
    one = F.coalesce("__parts", F.lit(1))
    cut = left.join(parts, on, "left").withColumn("__part", F.floor(F.rand(0) * one).cast("int")).drop("__parts")
    copies = right.join(parts, on, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), one - 1))).drop("__parts")
    return cut.join(copies, [*on, "__part"]).drop("__part")
