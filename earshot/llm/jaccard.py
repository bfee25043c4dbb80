"""N-gram Jaccard self-join: rare-first prefix filtering, then one exact check per pair.

A document is the set of its word shingles, each hashed to 64 bits (XXH3; two
shingles of a pair of documents share a hash by accident with a chance of 2^-64 each).
Equal sets are one class and searched once. In any one order of all shingles, two sets
of sizes a and b that reach the similarity t share a shingle among the first
a - ceil(t a) + 1 of one and b - ceil(t b) + 1 of the other, their prefixes. This is used
twice, so that most shingles are never moved:

* Candidates. The order puts a `SHARE` of all hashes, the smallest, first, rarest first
  by the exact number of classes that hold them, then the others by hash. The share
  nearly always holds the whole prefix, so only it is counted. A class whose
  prefix no other class meets has no link.
* Join. The whole sets of the candidates, every shingle counted, rarest first. Here a
  text with many words of its own has a prefix of its own, however much of the rest is
  common.

Prefixes meet by shingle, and three filters go over a meeting at places i and j:

* length: t max(a, b) <= min(a, b);
* positional: what follows i and j, itself included, must reach the overlap needed;
* suffix: fixed pivots divide the hash range; the sizes of the sets' parts between
  pivots bound their symmetric difference from below. (The parts of the whole sets
  are used instead of those of the suffixes, which holds at every shared shingle.)

A group of near copies is not compared in all pairs. First each prefix shingle's members
meet its leader only, the member with the smallest share of shingles of its own;
what passes is checked and joined to components. Then only shingles whose members
lie in several components are left; in those the members outside the largest
component meet all members of other components. No link between components is lost,
and a pair checked before is not checked again.

Defined results: a document without words has an empty set and no links; its
component is itself. With fewer words than a shingle has, the whole sequence is the one
shingle. component_id is the smallest doc_id of the component, null doc_ids aside
(null where all are null). Repeated rows each get their row. The size of a text is not
limited: a set is one row of 8 bytes a shingle. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import KEY_ROWS, join_small, join_spread, numbered, reliable, with_results
from earshot.llm.simhash import components

# Production parameters; a query's contract may set its own.
SHINGLE = 5
PERCENT = 80

# The share of all hashes that is counted, and the pivots of the suffix filter (a power of two).
SHARE = 0.2
PIVOTS = 16
PIVOT_SHIFT = np.uint64(64 - PIVOTS.bit_length() + 1)

# Shingles of very many classes are looked for in one class of so many; at most so many are found.
SAMPLED = 64
HOT_TOKENS = 1024


def shingles_of(text: str | None, words: int) -> set[bytes]:
    """Distinct shingles of a text, A-Z in lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(found) < words:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*(found[k:] for k in range(words)))))


def hashes_of(shingles: set[bytes]) -> np.ndarray:
    """Sorted distinct hashes."""
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), np.uint64, len(shingles)))


def overlap_of(size: Column, percent: int) -> Column:
    """The least overlap of a set with any set that reaches the similarity."""
    return F.expr(f"cast(({percent} * `{size}` + 99) div 100 as int)")


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def with_sets(docs: DataFrame, text: str, words: int, percent: int, share: float, carry: list[str]) -> DataFrame:
    """Per row: size, two halves of the set's digest, and the hashes of the counted share.

    `tokens` holds the `counted` hashes, and so many more as the prefix needs.
    """
    limit = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def compute(texts: list[str | None]) -> list:
        sizes, halves, counted, tokens = [], [], [], []
        for one in texts:
            shingles = shingles_of(one, words)
            hashes = hashes_of(shingles)
            digest = xxhash.xxh3_128_digest(hashes.tobytes())
            size = len(shingles)
            first = int(np.searchsorted(hashes, limit))
            prefix = size - -(-percent * size // 100) + 1 if size else 0
            sizes.append(size)
            halves.append(np.frombuffer(digest, "<i8"))
            counted.append(first)
            tokens.append(hashes[: max(first, prefix)].view(np.int64))
        first, second = zip(*halves) if halves else ((), ())
        return [sizes, [int(h) for h in first], [int(h) for h in second], counted, lists(tokens, pa.int64())]

    made = "size int, half1 bigint, half2 bigint, counted int, tokens array<bigint>"
    return with_results(docs, text, made, compute, carry)


def with_hashes(docs: DataFrame, text: str, words: int, carry: list[str]) -> DataFrame:
    """Per row: `tokens`, the whole set, its `size`, and the sizes of its `parts` between the pivots."""

    def compute(texts: list[str | None]) -> list:
        sets = [hashes_of(shingles_of(one, words)) for one in texts]
        parts = [np.bincount((one >> PIVOT_SHIFT).astype(np.int64), minlength=PIVOTS) for one in sets]
        return [[len(one) for one in sets], lists([one.view(np.int64) for one in sets], pa.int64()),
                lists(parts, pa.int32())]

    return with_results(docs, text, "size int, tokens array<bigint>, parts array<int>", compute, carry)


def shared_tokens(counted: DataFrame) -> DataFrame:
    """`counted` (node, token) with `df`, the number of rows of the token, without the tokens of one row.

    A row moves once, to the others of its token. A token of very many rows does not: only
    its counts are added up. A sample tells which these are; the result is the same for any.
    """
    sample = counted.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0)
    least = max(KEY_ROWS // SAMPLED, sample.count() // HOT_TOKENS)
    hot = reliable(sample.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > least).select("token"))
    by_token = F.count("*").over(Window.partitionBy("token"))
    if hot.isEmpty():
        return counted.withColumn("df", by_token).filter("df > 1")
    here = counted.join(F.broadcast(hot), "token", "left_semi")
    often = reliable(here.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    rest = counted.join(F.broadcast(hot), "token", "left_anti").withColumn("df", by_token).filter("df > 1")
    return rest.unionByName(counted.join(F.broadcast(often), "token"))


def prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(token, node, size, place, rare): the shingles of each prefix that other classes may hold.

    `classes` has node, size, counted (the first so many tokens are counted) and
    tokens. `rare` is the share of the counted shingles that no other class holds.
    """
    counted = classes.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("counted"))).alias("token"))
    shared = (
        shared_tokens(counted)
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    )
    length = F.col("size") - overlap_of("size", percent) + 1
    slim = classes.select("node", "size", "counted", length.alias("length"))
    rare = (F.col("alone") / F.greatest("counted", F.lit(1))).alias("rare")
    alone = slim.join(shared, "node").withColumn("alone", F.col("counted") - F.size("shared"))
    first = alone.select("node", "size", rare, F.inline(F.transform(
        F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.col("length") - F.col("alone"))),
        lambda x, i: F.struct(x["token"].alias("token"), (F.col("alone") + i).alias("place")),
    )))
    # Sets with too few counted shingles: the next ones by hash.
    short = classes.withColumn("length", length).filter("length > counted")
    rest = short.select("node", "size", F.lit(1.0).alias("rare"), F.inline(F.transform(
        F.slice("tokens", F.col("counted") + 1, F.col("length") - F.col("counted")),
        lambda x, i: F.struct(x.alias("token"), (F.col("counted") + i).alias("place")),
    )))
    return first.unionByName(rest).select("token", "node", "size", "place", "rare")


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """The nodes whose prefix meets another one."""
    entries = reliable(prefixes(classes, percent).select("token", "node"))
    met = entries.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token")
    return entries.join(met, "token").select("node").distinct()


def may_link(a: str, b: str, percent: int) -> Column:
    """The length, positional and suffix filters for a meeting of entries `a` and `b`."""
    both = f"({a}.size + {b}.size)"
    overlap = f"(({percent} * {both} + {100 + percent - 1}) div {100 + percent})"
    apart = f"aggregate(zip_with({a}.parts, {b}.parts, (x, y) -> abs(x - y)), 0, (s, x) -> s + x)"
    return F.expr(
        f"100 * least({a}.size, {b}.size) >= {percent} * greatest({a}.size, {b}.size)"
        f" and least({a}.size - {a}.place, {b}.size - {b}.place) >= {overlap}"
        f" and {apart} <= {both} - 2 * {overlap}"
    )


def entry(*extra: str) -> Column:
    return F.struct("node", "size", "place", "parts", *extra)


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    ).distinct()


def pairs_with_leaders(entries: DataFrame, percent: int) -> DataFrame:
    """Each entry with the leader of its shingle, where the filters let them pass."""
    leaders = entries.groupBy("token").agg(
        F.min(F.struct("rare", F.xxhash64("node").alias("by_chance"), "node", "size", "place", "parts")).alias("b"),
        F.count("*").alias("members"),
    ).filter("members > 1").select("token", "b")
    met = entries.select("token", entry().alias("a")).join(leaders, "token").filter("a.node <> b.node")
    return ordered_pairs(met.filter(may_link("a", "b", percent)))


def pairs_across(entries: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that meet in a shingle, where the filters let them pass."""
    rooted = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("token", "root").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("token").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots"))
        .filter("roots > 1").select("token", F.col("most.root").alias("largest"))
    )
    left = reliable(rooted.join(mixed, "token").select("token", "largest", entry("root").alias("a")))
    others = left.filter("a.root <> largest").select("token", F.col("a").alias("b"))
    # Of two members that both lie outside the largest component, one meets the other.
    met = left.join(others, "token").filter("a.root <> b.root and (a.root = largest or a.node < b.node)")
    return ordered_pairs(met.filter(may_link("a", "b", percent)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that reach the similarity, from (node, tokens)."""
    left = join_spread(pairs, sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a")), ["a"])
    both = join_spread(left, sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b")), ["b"], counted=pairs)
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.withColumn("common", common).filter(100 * F.col("common") >= percent * union).select("a", "b")


def classes_of(docs: DataFrame, text: str, words: int, percent: int, share: float) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row with its class, and the classes with their counted shingles.

    `docs` has `id` and the text. A text is known by two hashes, so that the texts of
    classes can be found again without moving all.
    """
    keyed = docs.select("id", F.xxhash64(text).alias("text1"), F.xxhash64(F.lit(1), text).alias("text2"), text)
    rows = reliable(with_sets(keyed, text, words, percent, share, ["id", "text1", "text2"]).withColumn(
        "row", F.monotonically_increasing_id()))
    own = ["half1", "half2", "size"]
    firsts = reliable(rows.groupBy(*own).agg(F.min("row").alias("node"), F.min("id").alias("first_id")))
    chosen = join_small(rows.filter("size > 0"), firsts.select(F.col("node").alias("row")), ["row"])
    classes = chosen.select(F.col("row").alias("node"), "text1", "text2", "size", "counted", "tokens")
    return rows.select("id", *own).join(firsts, own), classes


def links_between(docs: DataFrame, classes: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all classes of the similarity, directly or in steps."""
    wanted = reliable(classes.select("node", "text1", "text2").join(candidates(classes, percent), "node"))
    keyed = docs.select(F.xxhash64(text).alias("text1"), F.xxhash64(F.lit(1), text).alias("text2"), text)
    found = join_small(keyed, wanted, ["text1", "text2"])
    # A text may stand in several rows.
    sets = reliable(with_hashes(found, text, words, ["node"]).dropDuplicates(["node"]))
    entries = reliable(
        prefixes(sets.withColumn("counted", F.col("size")), percent).join(sets.select("node", "parts"), "node"))

    first = reliable(pairs_with_leaders(entries, percent))
    links = reliable(verified(first, sets, percent))
    roots = components(links).select("node", "root")
    second = reliable(pairs_across(entries, reliable(roots), percent).join(first, ["a", "b"], "left_anti"))
    return links.unionByName(verified(second, sets, percent))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = SHINGLE, percent: int = PERCENT, share: float = SHARE,
) -> DataFrame:
    """One row per document: `doc_id`, `n_shingles`, `component_id`.

    Documents link where 100 * intersection >= `percent` * union of their sets of
    shingles of so many `words`.
    """
    names = docs.columns
    own_id, own_text = (f"c{names.index(c)}" for c in (doc_id, text))
    plain = numbered(docs).select(F.col(own_id).alias("id"), F.col(own_text).alias("text"))
    rows, classes = classes_of(plain, "text", words, percent, share)
    links = links_between(plain, classes, "text", words, percent)
    roots = components(links)
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("smallest"))
    # An empty set is linked with nothing, not even with another empty set.
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("smallest"))
    return rooted.join(smallest, "root").select(
        F.col("id").alias(doc_id), F.col("size").cast("bigint").alias("n_shingles"), component.alias("component_id")
    )
