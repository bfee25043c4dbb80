"""Approximate nearest neighbours by largest inner product: cross-polytope hashing.

Vectors are divided by the largest norm and get one more component that makes them
unit vectors, so that the largest inner product is the smallest angle to the
query. Three rounds of random signs and a fast Hadamard transform rotate them; the
nearest signed axis is the hash. A table's bucket is the axes of so many rotations
as keep the mean bucket near `BUCKET`. Queries probe the buckets of their nearest
axes in every table; all vectors of a probed bucket are ranked exactly. Nothing is
capped: a bucket of more than `BUCKET` vectors is cut into parts, and its queries
go to every part.

How many probes a table gets is measured: the exact neighbours of `TUNE_QUERIES`
queries among all rows are found block by block. For each number of tables the least
number of probes that finds `TARGET` of them is known then, and the tables are taken
for which moving and ranking cost least (`MOVED`). Every row is indexed. Where `MOST_PROBES` of
`MOST_TABLES` tables do not find so many, a bucket is made of one rotation less, down
to one, of which every axis can be probed. Where probing costs as much as ranking
every row, that is done: one table, all buckets, so that the search is exact.
A task holds `PROBED` probes at a time, whatever the batch, one bucket's part and
`HELD` finds.

Equal vectors are one class: it is hashed, searched and ranked once, and stands
for its smallest ids, as many as a result can hold.

Defined results: rows with a null id or a vector that is null, empty, zero, of
another length than most, or that holds null or non-finite components take no
part. Repeated rows (same id and vector) are one row; a query's own row is every
row with its id. Ties go to the smaller id. No queries or one row give no rows.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import reliable, whole

# Production parameters.
NEIGHBOURS = 20
TABLES = 12
MOST_TABLES = 48
BUCKET = 4096
TARGET = 0.95
TUNE_QUERIES = 100
MOST_PROBES = 4096
SEED = 7
ROUNDS = 3
# Queries ranked against a bucket at once; pairs whose exact sums are made at once; finds a task holds.
QUERY_ROWS = 512
SUMMED = 1 << 16
HELD = 1 << 19
# Pairs that are ranked in the time in which a row is moved to its bucket.
MOVED = 150
# Slots over which the rows of one class are spread before its smallest ids are taken.
SLOTS = 64
# Probes a task makes at once.
PROBED = 1 << 20
# Scores this close, as a share of the product of the norms, are ranked by the exact sums.
CLOSE = 1e-9


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    count, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(count, width // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(count, width)
        half *= 2
    return rows / np.sqrt(width)


@dataclass
class Hasher:
    """`tables` tables of `functions` rotations for vectors of `dimension` components."""

    dimension: int
    largest: float
    tables: int
    functions: int

    @property
    def width(self) -> int:
        return 1 << int(self.dimension).bit_length()

    @property
    def buckets(self) -> int:
        """Buckets of a table."""
        return (2 * self.width) ** self.functions

    @property
    def most(self) -> int:
        """The probes a table can get: of one rotation all its axes."""
        return self.buckets if self.functions == 1 else min(MOST_PROBES, self.buckets)

    def rotated(self, rows: np.ndarray, table: int, function: int) -> np.ndarray:
        signs = np.random.default_rng([SEED, table, function]).choice([-1.0, 1.0], (ROUNDS, self.width))
        for own in signs:
            rows = hadamard(rows * own)
        return rows

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(vectors), self.width))
        rows[:, : self.dimension] = vectors / self.largest
        rows[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (rows * rows).sum(1)))
        return rows

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(vectors), self.width))
        rows[:, : self.dimension] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return rows

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table."""
        rows = self.points(vectors)
        codes = np.zeros((len(rows), self.tables), np.int64)
        for table, function in itertools.product(range(self.tables), range(self.functions)):
            turned = self.rotated(rows, table, function)
            axis = np.abs(turned).argmax(1)
            negative = turned[np.arange(len(rows)), axis] < 0
            codes[:, table] = codes[:, table] * (2 * self.width) + 2 * axis + negative
        return codes

    def probes(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The `count` nearest buckets of each query in each table, nearest first; -1 where there are fewer."""
        rows, axes = self.queries(vectors), 2 * self.width
        each = 1
        while each < axes and each**self.functions < (count if self.functions == 1 else 4 * count):
            each += 1
        found = np.full((len(rows), self.tables, count), -1, np.int64)
        for table in range(self.tables):
            codes, losses = np.zeros((len(rows), 1), np.int64), np.zeros((len(rows), 1))
            for function in range(self.functions):
                turned = self.rotated(rows, table, function)
                signed = np.stack([turned, -turned], 2).reshape(len(rows), axes)
                order = np.argsort(-signed, axis=1, kind="stable")[:, :each]
                gaps = signed.max(1, keepdims=True) - np.take_along_axis(signed, order, 1)
                codes = (codes[:, :, None] * axes + order[:, None, :]).reshape(len(rows), -1)
                losses = (losses[:, :, None] + gaps[:, None, :]).reshape(len(rows), -1)
            best = np.argsort(losses, axis=1, kind="stable")[:, :count]
            found[:, table, : best.shape[1]] = np.take_along_axis(codes, best, 1)
        return found

    def blocks(self, rows: int, count: int) -> list[slice]:
        """Ranges of `rows` queries whose probes are made together."""
        step = max(1, PROBED // (max(4 * count, 2 * self.width) + self.tables * count))
        return [slice(at, at + step) for at in range(0, rows, step)]


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes_of(vectors: DataFrame, ids: str, vector: str, most: int) -> DataFrame:
    """(cid, vec, members, first): the distinct vectors with their smallest `most` ids."""
    rows = vectors.select(whole(ids).cast("bigint").alias("id"), whole(vector).alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec"))).distinct()
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(SLOTS)))
    lists = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, most)
    place = F.row_number().over(Window.partitionBy("vec", "slot").orderBy("id"))
    fewest = rows.withColumn("place", place).filter(F.col("place") <= most)
    by_slot = fewest.groupBy("vec", "slot").agg(F.collect_list("id").alias("ids"))
    grouped = by_slot.groupBy("vec").agg(lists.alias("members"))
    return grouped.select(
        F.monotonically_increasing_id().alias("cid"), "vec", "members", F.col("members")[0].alias("first")
    )


def longest(vectors: np.ndarray) -> float:
    return float(np.linalg.norm(vectors, axis=1).max(initial=0.0))


def best_rows(scores: np.ndarray, most: int, norms: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the `most` largest of each row, and of all as close as rounding; `norms` is the largest product of norms."""
    if scores.shape[1] <= most:
        rows, places = np.indices(scores.shape)
        return rows.reshape(-1), places.reshape(-1)
    least = np.partition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most] - CLOSE * norms
    return np.nonzero(scores >= least[:, None])


def tuned(classes: DataFrame, queries: DataFrame, hasher: Hasher, target: float, sample: int) -> tuple[Hasher, int]:
    """The tables and probes that find `target` of the exact neighbours of a bounded sample of queries."""
    chosen = queries.orderBy(F.xxhash64("vec"), "cid").limit(sample).select("cid", "vec").collect()
    points, asking = classes.count(), queries.count()
    if not chosen:
        return hasher, 1
    ids = np.array([r["cid"] for r in chosen])
    own = np.array([r["vec"] for r in chosen], np.float64)
    shared = classes.sparkSession.sparkContext.broadcast((ids, own))
    dimension, tables = hasher.dimension, hasher.tables

    def run(batches):
        query_ids, vectors = shared.value
        largest = longest(vectors)
        for batch in batches:
            rows, cids = matrix(batch.column(1), dimension), batch.column(0).to_numpy()
            scores = vectors @ rows.T
            scores[query_ids[:, None] == cids[None, :]] = -np.inf
            query, places = best_rows(scores, NEIGHBOURS, largest * longest(rows))
            found = np.isfinite(scores[query, places])
            query, places = query[found], places[found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(scores[query, places]), batch.column(1).take(pa.array(places))],
                names=["query", "score", "vec"],
            )

    kind = classes.schema["vec"].dataType.simpleString()
    found = classes.select("cid", "vec").mapInArrow(run, f"query bigint, score double, vec {kind}")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    exact = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= NEIGHBOURS).collect()
    if not exact:
        return hasher, 1
    of = np.array([r["query"] for r in exact])
    near = np.array([r["vec"] for r in exact], np.float64)
    while True:
        needed = probes_for(hasher, own, near, of, target)
        able = np.flatnonzero(needed <= hasher.most)
        if len(able):
            break
        if hasher.tables < MOST_TABLES:
            hasher = replace(hasher, tables=2 * hasher.tables)
        else:
            hasher = replace(hasher, tables=tables, functions=hasher.functions - 1)
    needed = needed[able].astype(np.float64)
    moved, ranked = points + asking * needed, asking * needed * points / hasher.buckets
    best = int(np.argmin((able + 1) * (MOVED * moved + ranked)))
    hasher, probes = replace(hasher, tables=int(able[best]) + 1), int(needed[best])
    if hasher.tables * probes >= hasher.buckets:
        hasher = replace(hasher, tables=1, functions=1)
        probes = hasher.most
    return hasher, probes


def probes_for(hasher: Hasher, queries: np.ndarray, near: np.ndarray, of: np.ndarray, target: float) -> np.ndarray:
    """For 1, 2, ... tables: the probes each needs so that `target` of the rows `near` are found by their queries `of`.

    One more than the most where these do not find so many.
    """
    codes, most = hasher.codes(near), hasher.most
    ranks = np.full((len(of), hasher.tables), most)
    for block in hasher.blocks(len(queries), most):
        probes = hasher.probes(queries[block], most)
        for at in np.flatnonzero((of >= block.start) & (of < block.stop)):
            table, hit = np.nonzero(probes[of[at] - block.start] == codes[at][:, None])
            ranks[at, table] = hit
    found = np.sort(np.minimum.accumulate(ranks, axis=1), axis=0)
    return found[max(0, int(np.ceil(target * len(of))) - 1)] + 1


def ranked_in_buckets(rows: DataFrame, dimension: int, most: int) -> DataFrame:
    """(query, cid, first, score) of the best `most` other classes of each query in the buckets of a task.

    `rows` has tab, bucket, part, kind (0 for points, 1 for queries), cid, first
    and vec, sorted, with a bucket's rows in one partition.
    """

    def run(batches):
        state = Bucket(dimension, most)
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("tab", "bucket", "part", "kind")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            cids, firsts = batch.column("cid").to_numpy(), batch.column("first").to_numpy()
            vectors = matrix(batch.column("vec"), dimension)
            for begin, end in itertools.pairwise([0, *cuts.tolist(), len(keys)]):
                if begin < end:
                    state.add(tuple(keys[begin]), cids[begin:end], firsts[begin:end], vectors[begin:end])
                if state.full():
                    yield state.flush()
        yield state.flush()

    return rows.mapInArrow(run, "query bigint, cid bigint, first bigint, score double")


class Bucket:
    """The points of the open bucket, and the best finds of the queries seen."""

    def __init__(self, dimension: int, most: int):
        self.dimension, self.most = dimension, most
        self.key, self.points = None, []
        # arrays of query, cid, first and score
        self.finds: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, key: tuple, cids: np.ndarray, firsts: np.ndarray, vectors: np.ndarray) -> None:
        if key[:3] != self.key:
            self.key, self.points = key[:3], []
        if key[3] == 0:
            self.points.append((cids, firsts, vectors))
            return
        if not self.points:
            return
        if len(self.points) > 1:
            self.points = [tuple(map(np.concatenate, zip(*self.points)))]
        own_ids, own_firsts, points = self.points[0]
        norms = longest(points)
        for at in range(0, len(cids), QUERY_ROWS):
            queries, block = cids[at : at + QUERY_ROWS], vectors[at : at + QUERY_ROWS]
            rows, places = best_rows(block @ points.T, self.most + 1, norms * longest(block))
            others = own_ids[places] != queries[rows]
            rows, places = rows[others], places[others]
            for begin in range(0, len(rows), SUMMED):
                row, place = rows[begin : begin + SUMMED], places[begin : begin + SUMMED]
                exact = (points[place] * block[row]).sum(1)
                self.finds.append((queries[row], own_ids[place], own_firsts[place], exact))
                self.held += len(row)
                if self.held > 2 * HELD:
                    self.merge()

    def merge(self) -> None:
        """The best `most` classes of each query; a class found in several tables counts once."""
        query, cid, first, score = map(np.concatenate, zip(*self.finds))
        order = np.lexsort([first, -score, query])
        again = np.concatenate([[False], (np.diff(query[order]) == 0) & (np.diff(cid[order]) == 0)])
        order = order[~again]
        starts = np.flatnonzero(np.diff(query[order], prepend=query[order[0]] - 1))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        order = order[place < self.most]
        self.finds, self.held = [(query[order], cid[order], first[order], score[order])], len(order)

    def full(self) -> bool:
        """Whether the best finds of all queries seen are more than a task should hold."""
        if self.held <= HELD:
            return False
        self.merge()
        return self.held > HELD // 2

    def flush(self) -> pa.RecordBatch:
        names = ["query", "cid", "first", "score"]
        if not self.held:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array([], kind) for kind in kinds], names=names)
        self.merge()
        columns, self.finds, self.held = self.finds[0], [], 0
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)


def nearest(
    vectors: DataFrame,
    is_query: Column | str,
    ids: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = NEIGHBOURS,
    tables: int = TABLES,
    target: float = TARGET,
    bucket: int = BUCKET,
    tune_queries: int = TUNE_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query.

    `is_query` is a condition on the column `id`, which holds the ids.
    """
    spark, most = vectors.sparkSession, neighbours + 1
    own = vectors.select(whole(ids).cast("bigint").alias("id"), whole(vector).alias("vec"))
    own = own.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = own.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dimension = sizes["n"]
    own = own.filter(F.size("vec") == dimension)
    classes = reliable(classes_of(own, "id", "vec", most))
    asked = own.filter(is_query).distinct()
    queries = classes.join(asked.select(F.col("vec").alias("asked")).distinct(), F.col("vec") == F.col("asked"),
                           "left_semi")
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    count, largest = classes.agg(F.count("*"), F.max(squares)).first()
    functions = max(1, int(np.ceil(np.log(max(1, count / bucket)) / np.log(4 * dimension))))
    hasher = Hasher(dimension, float(np.sqrt(largest)) * (1 + 1e-12), tables, functions)
    hasher, probes = tuned(classes, queries, hasher, target, tune_queries)

    hashed = reliable(_hashed(classes, hasher))
    probing = _hashed(queries, hasher, probes)
    points = hashed.select("cid", "first", "vec", F.posexplode("codes").alias("tab", "bucket"))
    parts = reliable(
        points.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / bucket).cast("int").alias("parts"))
        .filter("parts > 1")
    )
    with_parts = points.join(parts, ["tab", "bucket"], "left").select(
        "tab", "bucket", F.pmod(F.xxhash64("cid"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
        F.lit(0).alias("kind"), "cid", "first", "vec",
    )
    asking = (
        probing.select("cid", "first", "vec", F.posexplode("codes").alias("tab", "buckets"))
        .select("cid", "first", "vec", "tab", F.explode("buckets").alias("bucket")).filter("bucket >= 0")
        .join(parts, ["tab", "bucket"], "left")
        .select("tab", "bucket", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
                F.lit(1).alias("kind"), "cid", "first", "vec")
    )
    keys = ["tab", "bucket", "part"]
    rows = with_parts.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys, "kind")
    found = ranked_in_buckets(rows, dimension, most)
    itself = queries.select(F.col("cid").alias("query"), "cid", "first", squares.alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    best = (
        found.unionByName(itself)
        .groupBy("query", "cid", "first").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    )
    listed = (
        best.join(classes.select("cid", "members"), "cid")
        .select("query", "score", F.explode("members").alias("vec_id"))
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
        .join(queries.select(F.col("cid").alias("query"), "vec"), "query")
    )
    return (
        asked.join(listed, "vec")
        .select("id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, neighbours).alias("near"))
        .select(F.col("id").alias("query_id"), F.posexplode("near").alias("place", "found"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "found.vec_id", (-F.col("found.far")).alias("score"))
    )


def _hashed(classes: DataFrame, hasher: Hasher, probes: int = 0) -> DataFrame:
    """cid, first, vec and `codes`: the bucket of each table, or with `probes` the list of its nearest buckets."""
    rows = classes.select("cid", "first", "vec")
    kind = "array<array<bigint>>" if probes else "array<bigint>"
    schema = f"cid bigint, first bigint, vec {rows.schema['vec'].dataType.simpleString()}, codes {kind}"

    def run(batches):
        for batch in batches:
            for block in hasher.blocks(batch.num_rows, probes):
                piece = batch.slice(block.start, block.stop - block.start)
                vectors = matrix(piece.column(2), hasher.dimension)
                codes = hasher.probes(vectors, probes) if probes else hasher.codes(vectors)
                yield pa.RecordBatch.from_arrays([*piece.columns, _lists(codes)], names=["cid", "first", "vec", "codes"])

    return rows.mapInArrow(run, schema)


def _lists(values: np.ndarray) -> pa.Array:
    """An array of two or more dimensions as lists, without Python objects."""
    made = pa.array(values.reshape(-1))
    for width in values.shape[:0:-1]:
        made = pa.ListArray.from_arrays(pa.array(np.arange(0, len(made) + 1, width, dtype=np.int32)), made)
    return made
