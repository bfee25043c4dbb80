"""The trie of conversation prefixes, as balanced parentheses, and what shared prefixes save.

A conversation is a path of turns (role, text); a node is a distinct sequence of
first turns. Texts are read once, to number the turns and hash them; from there on a
turn is two 64-bit hashes and a length. A node's key is the XOR of its turns' hashes,
each taken with its place, so keys are running sums along a path.

Paths are cut every `SEGMENT` turns, so that no row grows with a conversation; a
segment belongs to the trie below the node it starts from. Tries of deeper segments
are done first and handed to the nodes they hang from, so there are as many rounds as
the longest conversation has segments, nearly always one.

Equal segments are one, with a count. They are sorted by range, which puts every subtree
in one run, and each shard of up to `SHARD` turns is written as balanced parentheses:
a path closes what it does not share with the path before it and opens the rest.
Range min-max blocks of the excess give findclose, which ends a subtree; the rank of
the pairs "()" counts leaves, and running sums over the nodes in the order they open
give members and savings between open and close. The nodes open at a shard's border
(its spines) are in both shards; their sums are added by key afterwards, and a node
that was open before is not counted again.

Defined results: a null role or text is empty; a null turn comes first; equal turns are
ordered by role and text; repeated rows are turns of their own. Rows with a null conv_id
take no part. A conversation without turns is a member of the root. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import join_spread, reliable, whole

# Turns of a segment, turns of a shard, parentheses of a range min-max block.
SEGMENT = 1024
SHARD = 1 << 18
BLOCK = 512
# Ids joined into one text before the digests of a node are made.
CHUNK = 1 << 14

NO_ONE = np.iinfo(np.int64).max

# ---- turns -------------------------------------------------------------------


def by_parts(df: DataFrame, *keys) -> DataFrame:
    """Sorted over all parts, equal rows spread by chance."""
    spread = df.withColumn("__chance", F.rand(0))
    return spread.repartitionByRange(*keys, "__chance").sortWithinPartitions(*keys, "__chance").drop("__chance")


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv, place, hash1, hash2, bytes) of every turn; places count from 1 in each conversation.

    Sorted by range, so a very long conversation lies in many parts: its turns are
    numbered in each, and the turns of earlier parts are added.
    """
    rows = turns.select(
        whole("conv_id").cast("bigint").alias("conv"), whole("turn").alias("turn"),
        *(F.coalesce(whole(c), F.lit("")).alias(c) for c in ("role", "text")),
    ).filter("conv is not null")

    def run(batches):
        part = TaskContext.get().partitionId()
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column(0).to_numpy()
            firsts = np.flatnonzero(np.concatenate([[True], convs[1:] != convs[:-1]]))
            starts = np.repeat(firsts, np.diff([*firsts, len(convs)]))
            places = np.arange(1, len(convs) + 1) - starts
            if convs[0] == last:
                places[starts == 0] += count
            last, count = convs[-1], int(places[-1])
            hashes, sizes = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own, said = role.encode(), text.encode()
                hashes.append(xxhash.xxh3_128_digest(len(own).to_bytes(8) + own + said))
                sizes.append(len(said))
            halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(convs), part, np.int32)), pa.array(convs), pa.array(places),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(sizes, pa.int64())],
                names=["part", "conv", "place", "hash1", "hash2", "bytes"],
            )

    schema = "part int, conv bigint, place bigint, hash1 bigint, hash2 bigint, bytes bigint"
    placed = reliable(by_parts(rows, "conv", "turn", "role", "text").mapInArrow(run, schema))
    # One row a part: what its last conversation holds there. A conversation that goes on adds up.
    edges = placed.groupBy("part").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by("place", F.struct("conv", "place")).alias("n")
    ).orderBy("part").collect()
    before, open_conv, held = {}, None, 0
    for edge in edges:
        if edge["first"] == open_conv:
            before[edge["part"]] = held
        held = edge["n"] + (held if edge["first"] == edge["last"] == open_conv else 0)
        open_conv = edge["last"]
    firsts = {e["part"]: e["first"] for e in edges}
    if not before:
        return placed.drop("part")
    # At most one entry a part.
    added = placed.sparkSession.createDataFrame(
        [(part, firsts[part], n) for part, n in before.items()], "part int, conv bigint, before bigint")
    return placed.join(F.broadcast(added), ["part", "conv"], "left").select(
        "conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "hash1", "hash2", "bytes")


# ---- one shard ---------------------------------------------------------------


def parentheses(lengths: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Bits of sorted paths: 1 opens a node, 0 closes it; `shared` is what each has in common with the one before."""
    closes = np.concatenate([[0], lengths[:-1] - shared[1:]])
    opens = lengths - shared
    bits = np.repeat(np.tile(np.array([0, 1], np.int8), len(lengths)), np.stack([closes, opens], 1).ravel())
    return np.concatenate([bits, np.zeros(lengths[-1], np.int8)])


class RangeMinMax:
    """Excess of a parentheses sequence in blocks, with a tree of the blocks' minima."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.block = block
        self.count = -(-len(bits) // block)
        excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        self.excess = np.full(self.count * block, NO_ONE)
        self.excess[: len(bits)] = excess
        self.leaves = 1 << max(0, (self.count - 1).bit_length())
        self.least = np.full(2 * self.leaves, NO_ONE)
        self.least[self.leaves : self.leaves + self.count] = self.excess.reshape(-1, block).min(1)
        for node in range(self.leaves - 1, 0, -1):
            self.least[node] = min(self.least[2 * node], self.least[2 * node + 1])

    def first_in_block(self, blocks: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place in each block, from `start` on, where the excess is `wanted` or less; -1 where it is not."""
        found = np.empty(len(blocks), np.int64)
        grid, offsets = self.excess.reshape(-1, self.block), np.arange(self.block)
        for at in range(0, len(blocks), 4096):
            piece = slice(at, at + 4096)
            hits = (grid[blocks[piece]] <= wanted[piece, None]) & (offsets >= start[piece, None])
            found[piece] = np.where(hits.any(1), hits.argmax(1), -1)
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each open one: the first where the excess falls below its own."""
        wanted = self.excess[opens] - 1
        blocks = opens // self.block
        place = self.first_in_block(blocks, opens % self.block + 1, wanted)
        rest = np.flatnonzero(place < 0)
        node = blocks[rest] + self.leaves
        # Up to the first right neighbour whose minimum is low enough, then down to its first such block.
        climbing = np.ones(len(rest), bool)
        while climbing.any():
            left = node % 2 == 0
            right = np.minimum(node + 1, 2 * self.leaves - 1)
            here = climbing & left & (self.least[right] <= wanted[rest])
            node = np.where(here, right, np.where(climbing, node // 2, node))
            climbing &= ~here
        while (node < self.leaves).any():
            inner = node < self.leaves
            left = np.minimum(2 * node, 2 * self.leaves - 1)
            node = np.where(inner, np.where(self.least[left] <= wanted[rest], left, left + 1), node)
        blocks[rest] = node - self.leaves
        place[rest] = self.first_in_block(blocks[rest], np.zeros(len(rest), np.int64), wanted[rest])
        return blocks * self.block + place


def common_turns(values: np.ndarray, ends: np.ndarray, tries: np.ndarray) -> np.ndarray:
    """Nodes that each path shares with the one before it, the trie's top included; 0 for the first path."""
    lengths = np.diff(ends)
    shared = np.zeros(len(lengths), np.int64)
    if len(lengths) < 2:
        return shared
    least = np.minimum(lengths[1:], lengths[:-1])
    rows = np.repeat(np.arange(1, len(lengths)), least)
    offsets = np.arange(len(rows)) - np.repeat(np.cumsum(least) - least, least)
    differ = (values[ends[rows] + offsets] != values[ends[rows - 1] + offsets]).any(1)
    run = least.copy()
    places = np.flatnonzero(differ)
    own, first = np.unique(rows[places], return_index=True)
    run[own - 1] = offsets[places[first]]
    same = (tries[1:] == tries[:-1]).all(1)
    shared[1:] = np.where(same, run + 1, 0)
    return shared


NODE = (
    "key1 bigint, key2 bigint, depth bigint, parent1 bigint, parent2 bigint, parent bigint, conv bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, open boolean"
)
SEGMENT_COLUMNS = ["start1", "start2", "turns", "sizes", "n", "conv", "below_children", "below_leaves", "below_saved"]


def shard_nodes(rows: dict, top: int, before: int, after: int) -> list[np.ndarray]:
    """Columns of NODE for the nodes of a shard: sorted distinct segments of tries whose tops have depth `top`.

    `before` nodes of the first path are open from the shard before, `after` nodes of
    the last path stay open in the next one.
    """
    tries, values, ends, sizes = rows["tries"], rows["values"], rows["ends"], rows["sizes"]
    shared = common_turns(values, ends, tries)
    lengths = np.diff(ends) + 1
    bits = parentheses(lengths, shared)
    opens = np.flatnonzero(bits)
    size = (RangeMinMax(bits).findclose(opens) - opens + 1) // 2
    count = len(opens)
    opened = lengths - shared
    path = np.repeat(np.arange(len(lengths)), opened)
    level = np.arange(count) - np.repeat(np.cumsum(opened) - opened, opened) + shared[path]

    # Keys: running XOR along each path from the key of the trie's top.
    steps = np.zeros((len(values) + len(lengths), 2), np.int64)
    turn_rows = np.arange(len(values)) + np.repeat(np.arange(1, len(lengths) + 1), np.diff(ends))
    heads = ends[:-1] + np.arange(len(lengths))
    steps[turn_rows] = values
    steps[heads] = tries
    running = np.bitwise_xor.accumulate(steps, axis=0)
    base = np.zeros((len(lengths), 2), np.int64)
    base[1:] = running[heads[1:] - 1]
    key = running[heads[path] + level] ^ base[path]
    step_bytes = np.zeros(len(steps), np.int64)
    step_bytes[turn_rows] = sizes
    own_bytes = step_bytes[heads[path] + level]

    parent = np.arange(count) - 1
    spine: list[int] = []
    at = 0
    for same, new in zip(shared.tolist(), opened.tolist()):
        del spine[same:]
        parent[at] = spine[-1] if spine else -1
        spine += range(at, at + new)
        at += new

    known = (path == 0) & (level < before)
    open_after = np.zeros(count, bool)
    open_after[spine[:after]] = True
    last = np.cumsum(opened) - 1
    members = np.zeros(count, np.int64)
    members[last] = rows["n"]
    first = np.full(count + 1, NO_ONE)
    first[last] = rows["conv"]

    def inside(per_node: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        total = np.concatenate([[0], np.cumsum(per_node)])
        return total[np.arange(count) + size] - total[:count]

    # Leaves: pairs "()" by rank; a path that goes on in the next shard or below has none of its own.
    pairs = (bits[:-1] == 1) & (bits[1:] == 0)
    leaves = pairs[opens].astype(np.int64)
    if after == lengths[-1]:
        leaves[last[-1]] = 0
    hung = rows["below_leaves"]
    leaves[last] = np.where(hung > 0, hung, leaves[last])
    children = np.bincount(parent[(parent >= 0) & ~known], minlength=count)
    children[last] += rows["below_children"]

    n_convs = inside(members)
    below = np.zeros(count, np.int64)
    below[last] = rows["below_saved"]
    saved = inside(n_convs * own_bytes - np.where(known, 0, own_bytes) + below)
    spans = np.stack([np.arange(count), np.arange(count) + size], 1).ravel()
    conv = np.minimum.reduceat(first, spans)[::2]
    both = known | open_after
    up = np.maximum(parent, 0)
    # The top of a deeper trie has members that end there, in the trie above.
    resolved = (parent >= 0) & ~both[up] & ((level[up] > 0) | (top == 0))
    return [
        key[:, 0], key[:, 1], level + top, np.where(parent < 0, 0, key[up, 0]), np.where(parent < 0, 0, key[up, 1]),
        np.where(resolved, conv[up], NO_ONE), conv, n_convs, children, inside(leaves), saved, both,
    ]


def matrix(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, a row of two numbers each; lengths)."""
    flat = column.flatten()
    values = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1) if len(flat) else \
        np.empty((0, 2), np.int64)
    return values.astype(np.int64), np.asarray(column.value_lengths(), np.int64)


def segments_of(batch: pa.RecordBatch) -> dict:
    values, lengths = matrix(batch.column("turns"))
    numbers = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in SEGMENT_COLUMNS[4:]}
    return numbers | {
        "tries": np.stack([batch.column(c).to_numpy() for c in ("start1", "start2")], 1),
        "values": values, "ends": np.concatenate([[0], np.cumsum(lengths)]),
        "sizes": np.asarray(batch.column("sizes").flatten(), np.int64),
    }


def shards(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut to shards of about so many turns."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        weights = np.cumsum(np.asarray(batch.column("turns").value_lengths(), np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            done = weights[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(weights, done + turns - size, "right")))
            held.append(batch.slice(at, upto - at))
            size += int(weights[upto - 1] - done)
            at = upto
            if size >= turns:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def joint(one: dict | None, other: dict | None) -> int:
    """Nodes that the last path of one shard shares with the first of the next."""
    if one is None or other is None:
        return 0
    values = np.concatenate([one["values"][one["ends"][-2] :], other["values"][: other["ends"][1]]])
    ends = np.array([0, one["ends"][-1] - one["ends"][-2], len(values)])
    return int(common_turns(values, ends, np.stack([one["tries"][-1], other["tries"][0]]))[1])


def level_nodes(segments: DataFrame, top: int, shard: int = SHARD) -> DataFrame:
    """NODE rows of all tries whose tops have depth `top`, from their distinct segments."""
    keys = ["start1", "start2", "turns"]
    ordered = segments.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = reliable(ordered.withColumn("part", F.spark_partition_id()))
    # The first and last path of each part: two rows a part, of at most SEGMENT turns.
    edge = F.struct(*keys)
    edges = ordered.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last")).orderBy("part").collect()

    def path_of(row) -> dict:
        values = np.array([tuple(t) for t in row["turns"]], np.int64).reshape(-1, 2)
        return {"values": values, "ends": np.array([0, len(values)]),
                "tries": np.array([[row["start1"], row["start2"]]], np.int64)}

    around: dict[int, list[int]] = {e["part"]: [0, 0] for e in edges}
    for one, other in zip(edges, edges[1:]):
        around[one["part"]][1] = around[other["part"]][0] = joint(path_of(one["last"]), path_of(other["first"]))

    def run(batches):
        held, open_before, part = None, 0, None

        def done(rows, after):
            columns = shard_nodes(rows, top, open_before, after)
            types = [pa.bool_() if name.endswith("boolean") else pa.int64() for name in NODE.split(", ")]
            arrays = [pa.array(c, t, mask=c == NO_ONE if i == 5 else None)
                      for i, (c, t) in enumerate(zip(columns, types))]
            return pa.RecordBatch.from_arrays(arrays, names=[name.split()[0] for name in NODE.split(", ")])

        for batch in shards(batches, shard):
            rows = segments_of(batch)
            if held is None:
                part = batch.column("part")[0].as_py()
                open_before = around[part][0]
            else:
                after = joint(held, rows)
                yield done(held, after)
                open_before = after
            held = rows
        if held is not None:
            yield done(held, around[part][1])

    found = reliable(ordered.mapInArrow(run, NODE))
    own = ["key1", "key2", "depth"]
    merged = found.filter("open").groupBy(*own).agg(
        F.first("parent1").alias("parent1"), F.first("parent2").alias("parent2"),
        F.min("parent").alias("parent"), F.min("conv").alias("conv"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")), F.lit(True).alias("open"),
    )
    return found.filter("not open").unionByName(merged)


# ---- the whole trie ------------------------------------------------------------


def digests(ends: DataFrame) -> DataFrame:
    """(key1, key2, ends_sha256) of the ids at each node, ascending and joined by commas.

    A digest is one running hash by contract, so one task makes it. What reaches that
    task are texts of up to CHUNK joined ids, made by all tasks.
    """
    keys = ["key1", "key2", "conv"]

    def joined(batches):
        for batch in batches:
            own = np.stack([batch.column(c).to_numpy() for c in range(2)], 1)
            cuts = np.flatnonzero((own[1:] != own[:-1]).any(1)) + 1
            convs = batch.column(2).to_pylist()
            rows = []
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(convs)]):
                for at in range(begin, end, CHUNK):
                    ids = convs[at : min(end, at + CHUNK)]
                    rows.append((int(own[at, 0]), int(own[at, 1]), ids[0], ",".join(map(str, ids))))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            lists = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(lists, kinds)],
                                             names=["key1", "key2", "conv", "ids"])

    def hashed(batches):
        open_key, state = None, None
        for batch in batches:
            rows = []
            for one, two, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (one, two) == open_key:
                    state.update(f",{ids}".encode())
                    continue
                if open_key:
                    rows.append((*open_key, state.hexdigest()))
                open_key, state = (one, two), hashlib.sha256(ids.encode())
            yield packed(rows)
        yield packed([(*open_key, state.hexdigest())] if open_key else [])

    def packed(rows):
        kinds = (pa.int64(), pa.int64(), pa.string())
        lists = list(zip(*rows)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(lists, kinds)],
                                          names=["key1", "key2", "ends_sha256"])

    texts = by_parts(ends.select(*keys), *keys).mapInArrow(joined, "key1 bigint, key2 bigint, conv bigint, ids string")
    sorted_texts = texts.repartition("key1", "key2").sortWithinPartitions(*keys)
    return sorted_texts.mapInArrow(hashed, "key1 bigint, key2 bigint, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of all conversations in `convs` (conv), whose turns are in `turns`.

    `turns` has conv, place (1, 2, ...), hash1, hash2 and bytes. Returns conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the members that end at the node).
    """
    number = F.floor((F.col("place") - 1) / segment).cast("int")
    marked = turns.select(
        "conv", number.alias("number"), "place", "bytes",
        F.xxhash64("place", "hash1", "hash2").alias("turn1"), F.xxhash64("hash2", "place", "hash1").alias("turn2"),
    )
    own = F.sort_array(F.collect_list(F.struct("place", "turn1", "turn2", "bytes")))
    cut = marked.groupBy("conv", "number").agg(
        own.alias("rows"), F.bit_xor("turn1").alias("xor1"), F.bit_xor("turn2").alias("xor2"))
    empty = convs.select("conv").distinct().join(turns.select("conv").distinct(), "conv", "left_anti").select(
        "conv", F.lit(0).alias("number"), F.array().cast(cut.schema["rows"].dataType).alias("rows"),
        F.lit(0).cast("bigint").alias("xor1"), F.lit(0).cast("bigint").alias("xor2"))
    cut = reliable(cut.unionByName(empty))
    deepest = cut.agg(F.max("number")).first()[0]
    if deepest is None:
        return turns.sparkSession.createDataFrame(
            [], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
                "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    zero, last = F.lit(0).cast("bigint"), F.lit(True)
    if deepest:
        along = Window.partitionBy("conv").orderBy("number")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        starts = cut.select(
            "conv", "number", F.coalesce(F.bit_xor("xor1").over(before), zero).alias("start1"),
            F.coalesce(F.bit_xor("xor2").over(before), zero).alias("start2"),
            F.lead("number").over(along).isNull().alias("last"))
        cut = reliable(cut.join(starts, ["conv", "number"]))
    else:
        cut = cut.withColumns({"start1": zero, "start2": zero, "last": last})
    cut = cut.withColumns({"key1": F.col("start1").bitwiseXOR(F.col("xor1")),
                           "key2": F.col("start2").bitwiseXOR(F.col("xor2"))})
    distinct = cut.select(
        "conv", "number", "start1", "start2", "key1", "key2",
        F.transform("rows", lambda r: F.struct(r["turn1"].alias("a"), r["turn2"].alias("b"))).alias("turns"),
        F.transform("rows", lambda r: r["bytes"]).alias("sizes"),
    ).groupBy("number", "start1", "start2", "key1", "key2", "turns", "sizes").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"))
    distinct = reliable(distinct)

    found, below = None, None
    hung = ["below_children", "below_leaves", "below_saved"]
    for number in range(deepest, -1, -1):
        level = distinct.filter(F.col("number") == number)
        if below is None:
            level = level.withColumns({c: zero for c in hung})
        else:
            level = level.join(below, ["key1", "key2"], "left").fillna(0, hung)
        nodes = reliable(level_nodes(level.select(*SEGMENT_COLUMNS), number * segment, shard))
        below = nodes.filter(F.col("depth") == number * segment).select(
            "key1", "key2", *(F.col(c).alias(f"below_{name}") for c, name in
                              (("n_children", "children"), ("n_leaves", "leaves"), ("saved", "saved"))))
        # The top of a deeper trie is a node of the trie above.
        own = nodes.filter(F.col("depth") > number * segment) if number else nodes
        found = own if found is None else found.unionByName(own)
    found = reliable(found) if deepest else found

    # A parent on a border, or in the trie above, is known only now.
    unknown = reliable(found.filter("parent is null and depth > 0").drop("parent"))
    tops = found.filter((F.col("open") | (F.col("depth") % segment == 0))).select(
        F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv").alias("parent"))
    known = found.filter("parent is not null or depth = 0")
    found = known.unionByName(join_spread(unknown, tops, ["parent1", "parent2", "depth"]))
    ended = digests(cut.filter("last").select("key1", "key2", "conv"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.join(ended, ["key1", "key2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def with_shared_heads(turns: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) of rebuilt conversations: the first h turns of conversation c - c % `group`,
    then the own turns behind the first h, where h is the crc32 of the decimal c modulo `most` + 1."""
    convs = turns.select("conv").distinct().select(
        "conv", (F.col("conv") - F.col("conv") % group).alias("head"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h"))
    heads = turns.filter(F.col("place") <= most).withColumnRenamed("conv", "head")
    given = convs.join(heads, "head").filter("place <= h")
    lengths = given.groupBy("conv").agg(F.count("*").alias("given"))
    plan = convs.join(lengths, "conv", "left").select("conv", "h", F.coalesce("given", F.lit(0)).alias("given"))
    rest = turns.join(plan, "conv").filter("place > h").withColumn("place", F.col("given") + F.col("place") - F.col("h"))
    columns = ["conv", "place", "hash1", "hash2", "bytes"]
    return reliable(given.select(*columns).unionByName(rest.select(*columns))), convs.select("conv")
