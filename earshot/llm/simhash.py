"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is 1 if it is set in more than half of the XXH64
hashes of a text's word shingles (repeats included). Two fingerprints are linked
at `RADIUS` or fewer differing bits.

Covering tables: every bit position gets a nonzero vector of RADIUS + 1 bits;
for each nonzero vector v a table keeps the positions whose vector has an odd
product with v. RADIUS positions span at most RADIUS dimensions, so some v is
orthogonal to all of them: in that table two linked fingerprints agree on every
kept position. No link can be missed.

Work is on distinct fingerprints. A bucket of a table with up to `BUCKET` of them
is compared in one piece. A larger bucket is cut again: the free positions form
RADIUS + 2 blocks, of which linked fingerprints share two whole ones, so each
fingerprint goes to one small bucket per pair of blocks. There about a quarter of
the positions is free, which bounds such a bucket whatever the data. A bucket
gives at most one link per member (a spanning forest), never its pairs.
Components come from alternating star rounds over the links.

Defined results: a text without words has fingerprint zero and is linked like any
other; component_id is the smallest doc_id of the component, null doc_ids aside
(null where all are null). Repeated rows each get their row. An empty table gives
no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import numbered, reliable, with_results
from earshot.session import scratch_folder

# The contract's fingerprint and distance.
BITS = 64
SHINGLE = 3
SEED = 42
RADIUS = 2

# Distinct fingerprints a bucket may hold before it is cut again.
BUCKET = 2048
# Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(shingles), COUNTED):
        hashed = np.array([digest(s, SEED) for s in shingles[start : start + COUNTED]], "<u8")
        ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE,
    carry: list[str] | None = None,
) -> DataFrame:
    """`docs` with the fingerprint of each text as a bigint."""
    return with_results(
        docs, text, f"`{name}` bigint", lambda texts: [[fingerprint(t, shingle) for t in texts]], carry
    )


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask of kept positions per nonzero vector of radius + 1 bits."""
    vectors = 2 ** (radius + 1)
    of_position = [1 + i % (vectors - 1) for i in range(BITS)]
    return [
        sum(1 << i for i, own in enumerate(of_position) if (own & v).bit_count() % 2) for v in range(1, vectors)
    ]


def block_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks of all kept positions of `mask` and two of radius + 2 blocks of the free ones."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    blocks = [sum(1 << i for i in free[k :: radius + 2]) for k in range(radius + 2)]
    return [mask | a | b for a, b in itertools.combinations(blocks, 2)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A link from each member to the member it was reached from; no links between components."""
    links, rest = [], np.sort(values)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            centre = queue.pop()
            near = np.bitwise_count(rest ^ centre) <= radius
            reached = rest[near]
            links += [(int(centre), int(other)) for other in reached]
            queue += list(reached)
            rest = rest[~near]
    return links


def bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) inside the arrays of distinct fingerprints in the column `members`."""

    def run(batches):
        for batch in batches:
            links = [link for own in batch.column(0)
                     for link in forest(own.values.to_numpy().view(np.uint64), radius)]
            if links:
                found = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return buckets.select("members").mapInArrow(run, "a bigint, b bigint")


def keys(masks: list[int], value: Column) -> Column:
    """An array of (table, key) for each mask."""
    return F.array(*(
        F.struct(F.lit(t).alias("table"), value.bitwiseAND(F.lit(signed(mask))).alias("key"))
        for t, mask in enumerate(masks)
    ))


def links_within(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links that connect all distinct fingerprints `fp` within `radius` bits, directly or in steps."""
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.inline(keys(masks, F.col("fp"))))
    sizes = reliable(keyed.groupBy("table", "key").agg(F.count("*").alias("size")).filter("size > 1"))
    small = (
        keyed.join(sizes.filter(F.col("size") <= bucket), ["table", "key"])
        .groupBy("table", "key")
        .agg(F.collect_list("fp").alias("members"))
    )
    cut = F.lit(None)
    for table, mask in enumerate(masks):
        cut = F.when(F.col("table") == table, keys(block_masks(mask, radius), F.col("fp"))).otherwise(cut)
    large = (
        keyed.join(sizes.filter(F.col("size") > bucket).select("table", "key"), ["table", "key"])
        .select("table", "fp", F.explode(cut).alias("block"))
        .groupBy("table", "block")
        .agg(F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
    )
    return bucket_links(small.select("members").unionByName(large.select("members")), radius).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes without a link are left out.

    Rounds of a large star (every larger neighbour of a node is linked to the
    smallest one around it) and a small star (the same for the smaller ones),
    until nothing changes. Minima are pre-aggregated, so a node with very many
    links costs no more than its links.
    """
    edges = reliable(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        edges = reliable(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(
    fingerprints: DataFrame, fp: str, doc_id: str, radius: int = RADIUS, bucket: int = BUCKET
) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint."""
    distinct = reliable(
        fingerprints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id"))
    )
    roots = components(links_within(distinct, radius, bucket))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    linked = reliable(labelled)
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return linked.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: `doc_id`, `fp`, `component_id`."""
    own = reliable(with_fingerprint(docs, text, "fp", shingle, [doc_id]))
    groups = classes(own, "fp", doc_id, radius, bucket).select("fp", "component_id")
    return own.join(groups, "fp").select(doc_id, "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET,
) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; the columns of `docs`.

    Of repeated rows with that doc_id one stays.
    """
    spark, names = docs.sparkSession, docs.columns
    frame = numbered(docs)
    own_id, own_text = (f"c{names.index(c)}" for c in (doc_id, text))
    folder = scratch_folder(spark, "fingerprints")
    # Numbers of rows hold only for a table that is written.
    numbered_rows = with_fingerprint(frame, own_text, "fp", shingle).withColumn("row", F.monotonically_increasing_id())
    numbered_rows.write.parquet(folder)
    own = spark.read.parquet(folder)
    slim = own.select("row", F.col(own_id).alias("own_id"), "fp")
    first = F.col("own_id").eqNullSafe(F.col("component_id"))
    stay = slim.join(classes(slim, "fp", "own_id", radius, bucket), "fp").filter(first)
    kept = own.join(stay.groupBy("root").agg(F.min("row").alias("row")).select("row"), "row", "left_semi")
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
