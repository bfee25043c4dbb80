"""Hard negatives by exact integer scores: a residue-number-system GEMM and a window.

Vectors are made integer (`floor(SCALE * x)`). Component matrices are reduced modulo
several small primes, to residues of at most (p - 1) / 2 in size, and multiplied in
float32: the primes are so small that no sum of products passes 2^24, where float32
is still exact. The primes' product is above twice the largest possible score, so
Chinese remaindering (in mixed radix, with signed digits) gives the exact signed score.

Blocks: rows are dealt into parts of about `PART` rows; a task holds one part and
streams the anchors against it, `ANCHORS` at a time. Positives are looked for in the
parts of the anchor's own label only (a large label is many parts), negatives in all
parts. Each part gives at most its best few per anchor, or per anchor and positive;
the best of those are the result. Nothing is broadcast or collected.

Defined results: rows with a null id, a null label, a null or empty vector, a null or
non-finite component, a length other than the most common one (the longer, if
tied), or an integer vector of a squared length of 2^63 or more (a score might not
fit a long) take no part; zero vectors do. Equal rows (id, label and vector) are one
row; rows that share an id without being equal are rows of their own, and an anchor is
never its own positive or negative, nor is any row with its id. Ties go to the smaller
id. No anchors or an empty table give no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import reliable, whole

# Fixed values of the contract.
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative's score is at least this share (in hundredths) of the positive's, and at most the positive's.
LEAST_PERCENT = 80

# Rows a task holds, anchors multiplied with them at once, components multiplied before a reduction.
PART = 32_768
ANCHORS = 128
SLICE = 1024
# Integers up to this are exact in float32.
EXACT = 1 << 24


def primes_below(limit: int) -> list[int]:
    """Primes from the largest below `limit` down."""
    sieve = np.ones(max(limit, 2), bool)
    sieve[:2] = False
    for n in range(2, int(limit**0.5) + 1):
        sieve[n * n :: n] = False
    return np.flatnonzero(sieve)[::-1].tolist()


def choose_primes(dimension: int, bound: int) -> list[int]:
    """Primes whose products of `dimension` residues stay exact, enough for scores of -bound to bound."""
    half = int((EXACT / min(dimension, SLICE)) ** 0.5)
    chosen, product = [], 1
    for prime in primes_below(2 * half + 2):
        if product > 2 * bound + 1:
            break
        chosen.append(prime)
        product *= prime
    return chosen


def signed_residue(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues from -(p - 1) / 2 to (p - 1) / 2 (0 and 1 for p = 2)."""
    half = (prime - 1) // 2
    return (values + half) % prime - half if prime > 2 else values % 2


class Residues:
    """An integer matrix as one float32 matrix per prime."""

    def __init__(self, rows: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [signed_residue(rows, p).astype(np.float32) for p in primes]

    def scores(self, other: Residues) -> np.ndarray:
        """Exact inner products of the rows of both, as 64-bit integers."""
        total, product = None, 1
        for prime, own, others in zip(self.primes, self.parts, other.parts):
            residue = np.zeros((len(own), len(others)), np.int64)
            for at in range(0, own.shape[1], SLICE):
                residue += (own[:, at : at + SLICE] @ others[:, at : at + SLICE].T).astype(np.int64)
            if total is None:
                total, product = signed_residue(residue, prime), prime
                continue
            digit = signed_residue((residue % prime - total % prime) % prime * pow(product, -1, prime), prime)
            # Products wrap at 64 bits; the last sum is a score, which fits.
            total = total + digit * np.array(product, np.uint64).astype(np.int64)
            product = product * prime % (1 << 64)
        return total


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` largest scores, largest first, ties to the smaller id."""
    places = np.arange(len(scores))
    if len(scores) > most:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return places[np.lexsort([ids[places], -scores[places]])][:most]


class Part:
    """The rows of the open part, as residues, and the best finds of the anchors streamed against it."""

    def __init__(self, dimension: int, primes: list[int]):
        self.dimension, self.primes = dimension, primes
        self.key, self.rows, self.residues = None, [], None

    def add(self, key: tuple, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        if key != self.key:
            self.key, self.rows = key, []
        self.rows.append((ids, labels, vectors))
        self.residues = None

    def against(self, key: tuple, vectors: np.ndarray):
        """(place of the anchor, scores, ids, labels) of each anchor, or nothing where the part has no rows."""
        if key != self.key:
            return
        if self.residues is None:
            self.ids, self.labels, rows = map(np.concatenate, zip(*self.rows))
            self.rows = [(self.ids, self.labels, rows)]
            self.residues = Residues(rows, self.primes)
        for at in range(0, len(vectors), ANCHORS):
            scores = Residues(vectors[at : at + ANCHORS], self.primes).scores(self.residues)
            for place, row in enumerate(scores):
                yield at + place, row, self.ids, self.labels


def positives_of(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, most: int):
    """(place of the positive: 0, id, score) of the best rows with the anchor's label."""
    other = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["id"]))
    for place in other[best(scores[other], ids[other], most)]:
        yield 0, int(ids[place]), int(scores[place])


def negatives_of(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, most: int):
    """(place of the positive, id, score) of the best rows of other labels in the window of each positive."""
    other = np.flatnonzero((labels != anchor["label"]) & (ids != anchor["id"]))
    own, own_ids = scores[other], ids[other]
    for place, positive in enumerate(anchor["positives"]):
        high = positive["score"]
        least = -(-LEAST_PERCENT * high // 100)
        inside = np.flatnonzero((own >= least) & (own <= high))
        for found in inside[best(own[inside], own_ids[inside], most)]:
            yield place, int(own_ids[found]), int(own[found])


def search(rows: DataFrame, anchors: DataFrame, dimension: int, primes: list[int], select, most: int) -> DataFrame:
    """(anchor, place, id, score): what `select` finds for each anchor in each part, at most `most` a place.

    Both have tab and part; a part's rows are met by the anchors of that part.
    """
    columns = ["tab", "part", "kind", "row", "id", "label", "vec", "positives"]
    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    rows = rows.withColumns({"kind": F.lit(0), "positives": none})
    anchors = anchors.withColumn("kind", F.lit(1))
    if "positives" not in anchors.columns:
        anchors = anchors.withColumn("positives", none)
    met = rows.select(*columns).unionByName(anchors.select(*columns))
    met = met.repartition("tab", "part").sortWithinPartitions("tab", "part", "kind")

    def run(batches):
        part = Part(dimension, primes)
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("tab", "part", "kind")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            vectors = np.asarray(batch.column("vec").flatten(), np.int64).reshape(-1, dimension)
            for begin, end in itertools.pairwise([0, *cuts.tolist(), len(keys)]):
                if begin == end:
                    continue
                tab, number, kind = keys[begin].tolist()
                if kind == 0:
                    part.add((tab, number), ids[begin:end], labels[begin:end], vectors[begin:end])
                    continue
                asked = batch.slice(begin, end - begin).select(["row", "id", "label", "positives"]).to_pylist()
                found = []
                for place, *scored in part.against((tab, number), vectors[begin:end]):
                    found += [(asked[place]["row"], *one) for one in select(asked[place], *scored, most)]
                kinds = {"anchor": pa.int64(), "place": pa.int32(), "id": pa.int64(), "score": pa.int64()}
                lists = list(zip(*found)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(lists, kinds.values())],
                                                 names=list(kinds))

    found = met.mapInArrow(run, "anchor bigint, place int, id bigint, score bigint")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def usable(vectors: DataFrame, ids: str, label: str, vector: str, scale: int) -> DataFrame:
    """id, label and integer vector of the rows that take part, whatever their length."""
    rows = vectors.select(
        whole(ids).cast("bigint").alias("id"), whole(label).cast("bigint").alias("label"), whole(vector).alias("vec")
    )
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.filter("id is not null and label is not null and size(vec) > 0").filter(finite)
    scaled = rows.withColumn("vec", F.transform("vec", lambda x: x.cast("double") * scale))
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + (F.abs(x) + 1) * (F.abs(x) + 1))
    fits = scaled.withColumn("square", square).filter(F.col("square") < float(2**63))
    return fits.withColumn("vec", F.transform("vec", lambda x: F.floor(x)))


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | str,
    ids: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    part: int = PART,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on the column `id`, which holds the ids.
    """
    every = usable(vectors, ids, label, vector, scale)
    found = every.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"), F.max("square").alias("square"))
    most = found.orderBy(F.desc("rows"), F.desc("n")).first()
    if most is None:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                "negative_score bigint")
    dimension = most["n"]
    # No score is larger than the largest squared length; the sum above is rounded, and rounded up here.
    primes = choose_primes(dimension, int(most["square"] * (1 + 1e-9)) + 1)
    rows = every.filter(F.size("vec") == dimension).select("id", "label", "vec").distinct()
    rows = reliable(rows.withColumn("row", F.monotonically_increasing_id()))
    anchors = rows.filter(is_anchor)

    by_label = rows.groupBy("label").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    dealt = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part")
    spread = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    near = search(
        rows.join(by_label, "label").select("*", dealt, F.col("label").alias("tab")),
        anchors.join(by_label, "label").select("*", spread, F.col("label").alias("tab")),
        dimension, primes, positives_of, positives,
    )
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    lists = lists.select("anchor", F.transform("found", lambda x: F.struct(x["id"], x["score"])).alias("positives"))
    asking = reliable(anchors.join(lists, F.col("row") == F.col("anchor")).drop("anchor"))

    parts, tab = max(1, -(-rows.count() // part)), F.lit(0).cast("bigint").alias("tab")
    far = search(
        rows.select("*", tab, F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")),
        asking.select("*", tab, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")),
        dimension, primes, negatives_of, negatives,
    )
    own = asking.select(
        F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("positives").alias("place", "positive")
    )
    return far.join(own, ["anchor", "place"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
