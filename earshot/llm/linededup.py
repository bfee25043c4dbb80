"""Line dedup: repeated runs of lines, found by a suffix array over line ids; later copies go.

Every text is a sequence of its lines with a word; line ids are ranks of the
lines that stand twice or more in the corpus. Prefix doubling gives each suffix
the rank of its first 1, 2, 4, ... lines: the ranks of (first half, second half)
are sorted by range over the cluster, equal pairs get equal ranks, and a pair
that stands once drops out, since no longer run can repeat there (a document's
end and a line that stands once act as marks of their own). Ranks keep the order
of the suffixes, so equal ranks are the intervals of the suffix array whose
longest common prefix is at least that long.

A run is repeated if it has `MIN_WORDS` words and stands twice. It is enough to
look at the shortest runs that reach that many words from each first line on, and
back from each last line: every longer repeated run is the union of such runs
inside it. The interval of a run of n lines is given by the ranks of its first and
of its last 2^k lines, 2^k <= n. Doubling therefore ends at MIN_WORDS lines.

In each interval the earliest run (by doc_id, then row, then line) stays; the
lines of all others are deleted, with lines without a word inside them. So each
line's earliest copy stays. Lines are equal if all characters are.

Defined results: a null text stays null and an empty one empty; a text all of
whose lines go becomes empty; rows with equal doc_id are documents of their own,
in the order of the input's partitions; null doc_ids come first. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import numbered, reliable, with_results
from earshot.session import scratch_folder

# Production parameter. Passages to be caught have over 50 words; half of that also
# catches one whose first and last line are joined to other text.
MIN_WORDS = 25

LINES = "lines array<struct<at:int,h1:bigint,h2:bigint>>, windows array<struct<first:int,size:int>>"


def worded(text: str | None) -> tuple[list[bytes], list[int], list[int]]:
    """Lines of a text, the numbers of those with a word, and their words."""
    lines = (text or "").encode("utf-8").split(b"\n")
    counts = [len(line.split()) for line in lines]
    places = [i for i, n in enumerate(counts) if n]
    return lines, places, [counts[i] for i in places]


def windows_of(words: list[int], min_words: int) -> np.ndarray:
    """(first, size) of the shortest runs of lines with `min_words` words, from each first and to each last line."""
    ends = np.cumsum(words, dtype=np.int64)
    before = ends - words
    last = np.searchsorted(ends, before + min_words)
    forward = np.flatnonzero(last < len(words))
    first = np.searchsorted(before, ends - min_words, side="right") - 1
    backward = np.flatnonzero(first >= 0)
    found = np.concatenate([
        np.stack([forward, last[forward] - forward + 1], 1),
        np.stack([first[backward], backward - first[backward] + 1], 1),
    ])
    return np.unique(found, axis=0)


def lists(offsets: list[int], columns: dict[str, pa.Array]) -> pa.Array:
    values = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def describe(texts: list[str | None], min_words: int) -> list[pa.Array]:
    """The lines (place, 128-bit hash) and windows of each text."""
    line_ends, window_ends, at, hashes, windows = [0], [0], [], [], [np.empty((0, 2), np.int64)]
    for text in texts:
        lines, places, words = worded(text)
        own = windows_of(words, min_words) if words else windows[0]
        at += range(len(places)) if len(own) else ()
        hashes += [xxhash.xxh3_128_digest(lines[i]) for i in places] if len(own) else ()
        windows.append(own)
        line_ends.append(len(at))
        window_ends.append(window_ends[-1] + len(own))
    halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    spans = np.concatenate(windows).astype(np.int32)
    return [
        lists(line_ends, {"at": pa.array(at, pa.int32()), "h1": pa.array(halves[:, 0]), "h2": pa.array(halves[:, 1])}),
        lists(window_ends, {"first": pa.array(spans[:, 0]), "size": pa.array(spans[:, 1])}),
    ]


def ranked(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """`row`, `at` and the rank of (left, right) among all pairs, without the pairs that stand once.

    The distinct pairs are sorted by range; the number of a row in that order is
    its rank, which holds within one execution: the result is to be stored. Counting
    is pre-aggregated, so a pair of very many places is cheap.
    """
    names = (
        pairs.groupBy(left, right).agg(F.count("*").alias("n")).filter("n > 1")
        .repartitionByRange(left, right).sortWithinPartitions(left, right)
        .select(left, right, F.monotonically_increasing_id().alias("id"))
    )
    return pairs.join(names, [left, right]).select("row", "at", F.col("id").alias("rank"))


def suffix_ranks(lines: DataFrame, longest: int) -> dict[int, DataFrame]:
    """(row, at, rank) of the suffixes whose first 1, 2, 4, ... lines stand twice, up to `longest` lines.

    `lines` has row, at (the number of the line in its text) and the hash h1, h2.
    """
    level = reliable(ranked(lines, "h1", "h2"))
    levels = {1: level}
    size = 1
    while 2 * size <= longest and not level.isEmpty():
        after = level.select("row", (F.col("at") - size).alias("at"), F.col("rank").alias("then"))
        level = reliable(ranked(level.join(after, ["row", "at"]), "rank", "then"))
        size *= 2
        levels[size] = level
    return levels


def later_copies(levels: dict[int, DataFrame], windows: DataFrame) -> DataFrame:
    """The windows (row, doc_id, first, size) that repeat an earlier one."""
    ranks = None
    for size, level in levels.items():
        own = level.withColumn("power", F.lit(size))
        ranks = own if ranks is None else ranks.unionByName(own)
    # the largest power of two not above the size; sizes beyond the last level match nothing
    power = F.expr("cast(pow(2, length(bin(size)) - 1) as int)")
    head = ranks.select("row", F.col("at").alias("first"), "power", F.col("rank").alias("head"))
    tail = ranks.select("row", F.col("at").alias("second"), "power", F.col("rank").alias("tail"))
    named = reliable(
        windows.withColumn("power", power).withColumn("second", F.col("first") + F.col("size") - F.col("power"))
        .join(head, ["row", "first", "power"])
        .join(tail, ["row", "second", "power"])
        .select("row", "doc_id", "first", "size", "head", "tail")
    )
    place = F.struct("doc_id", "row", "first")
    # stored, so that the join can split an interval that holds very many windows
    earliest = reliable(
        named.groupBy("head", "tail", "size").agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
        .filter("n > 1").select("head", "tail", "size", "earliest")
    )
    return (
        named.join(earliest, ["head", "tail", "size"])
        .filter(~place.eqNullSafe(F.col("earliest")))
        .select("row", "doc_id", "first", "size")
    )


def without(text: str | None, windows: list[dict]) -> tuple[str | None, int]:
    """A text without the lines of its deleted windows, and the number of lines deleted."""
    if not windows:
        return text, 0
    lines, places, _ = worded(text)
    steps = np.zeros(len(lines) + 1, np.int64)
    for window in windows:
        steps[places[window["first"]]] += 1
        steps[places[window["first"] + window["size"] - 1] + 1] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return b"\n".join([line for line, out in zip(lines, gone) if not out]).decode("utf-8"), int(gone.sum())


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
) -> DataFrame:
    """The columns of `docs` as c0, c1, ... with the remaining text, `n_lines` and `n_deleted`."""
    spark: SparkSession = docs.sparkSession
    names = docs.columns
    own_id, own_text = (f"c{names.index(c)}" for c in (doc_id, text))
    folder = scratch_folder(spark, "lines")
    # Numbers of rows hold only for a table that is written.
    numbered(docs).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)

    described = with_results(
        stored.select("row", F.col(own_id).alias("doc_id"), F.col(own_text).alias("text")), "text", LINES,
        lambda texts: describe(texts, min_words), ["row", "doc_id"],
    ).filter(F.size("windows") > 0)
    table = scratch_folder(spark, "line-ids")
    described.write.parquet(table)
    described = spark.read.parquet(table)
    lines = described.select("row", F.inline("lines"))
    windows = described.select("row", "doc_id", F.inline("windows"))
    gone = (
        later_copies(suffix_ranks(lines, min_words), windows)
        .groupBy("row").agg(F.collect_list(F.struct("first", "size")).alias("gone"))
    )

    joined = stored.join(gone, "row", "left").drop("row")
    place, place_gone = joined.columns.index(own_text), joined.columns.index("gone")
    kept = [c for c in joined.columns if c != "gone"]
    schema = joined.select(kept).schema.add("n_lines", "long").add("n_deleted", "long")

    def run(batches):
        for batch in batches:
            texts, windows_gone = batch.column(place).to_pylist(), batch.column(place_gone).to_pylist()
            results = [without(t, w) for t, w in zip(texts, windows_gone)]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != place_gone]
            columns[kept.index(own_text)] = pa.array([t for t, _ in results], pa.string())
            columns += [pa.array([(t or "").count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                        pa.array([n for _, n in results], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)


def keep_first_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """`docs` with the remaining texts; `n_chars`, where it stands in the input, becomes their length."""
    names = docs.columns
    found = dedup_lines(docs, doc_id, text, min_words)
    own_text = F.col(f"c{names.index(text)}")
    return found.select(*(
        (F.length(own_text).cast(docs.schema[c].dataType) if c == n_chars else F.col(f"c{i}")).alias(c)
        for i, c in enumerate(names)
    ))
