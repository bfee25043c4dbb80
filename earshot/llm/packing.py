"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length and a
rest. Pieces are placed from the longest to the shortest, each into the open bin
with the least room that still holds it. Where none does, a bin of the size with
the least cost per token expected in it is opened: what the piece and its like
leave free counts as filled as far as shorter pieces are left for it, after the
room of the bins already open. At the end every bin shrinks to the smallest
permitted length that holds its contents.

Pieces of one length are alike, so the plan is made on the histogram of lengths:
at most `max(capacities)` entries, whatever the number of documents. It gives, for
the pieces of a length by number, ranges of bins and places. On the cluster each
piece gets its number among those of its length (numbered within slots of a
bounded size, then shifted by the slots before) and reads its bin off the plan.

Defined results: a document of no tokens gives no piece; rows with equal doc_id
are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import reliable, whole

# Production parameters: permitted lengths, and the cost of a sequence: a fixed
# part, its length, and attention that grows with the square.
CAPACITIES = (1024, 2048, 4096, 8192)
FIXED_COST = 32
SQUARE_COST = 1 / (1 << 18)

# Pieces numbered together, and the most slots the driver plans for.
SLOT_ROWS = 5_000
MOST_SLOTS = 200_000


def sequence_cost(capacity: int) -> float:
    return FIXED_COST + capacity + SQUARE_COST * capacity * capacity


@dataclass
class Plan:
    """Ranges of pieces (length, first number) with their first bin and place; ranges of bins."""

    segments: list[tuple[int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)  # first bin, bins, used, capacity


def plan_bins(
    histogram: dict[int, int],
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> Plan:
    """The best-fit plan for so many pieces of each length."""
    sizes = sorted(capacities)
    plan = Plan()
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> heap of (first bin, bins, capacity)
    lengths = sorted(histogram)
    tokens_upto = np.concatenate([[0], np.cumsum([n * histogram[n] for n in lengths])])
    free = next_bin = 0

    def keep(room: int, first: int, count: int, capacity: int) -> None:
        if count:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            heapq.heappush(groups[room], (first, count, capacity))

    def fill(first: int, count: int, capacity: int, room: int, length: int, number: int, left: int) -> int:
        """Place `left` pieces into `count` alike bins, as many as fit into each; returns those placed."""
        nonlocal free
        each = room // length
        full = min(count, left // each)
        rest = min(each, left - full * each) if full < count else 0
        for bins, start, per_bin in ((full, first, each), (1, first + full, rest)):
            if bins and per_bin:
                for turn in range(per_bin):
                    plan.segments.append((length, number, start, capacity - room + turn * length))
                    number += bins
                keep(room - per_bin * length, start, bins, capacity)
        untouched = count - full - (1 if rest else 0)
        keep(room, first + count - untouched, untouched, capacity)
        placed = full * each + rest
        free -= placed * length
        return placed

    for length in reversed(lengths):
        number, left = 0, histogram[length]
        opened = None
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count, capacity = heapq.heappop(groups[room])
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                if opened is None:
                    opened = best_size(length, left, sizes, cost, lengths, tokens_upto, free)
                capacity = room = opened
                count = -(-left // (capacity // length))
                first, next_bin = next_bin, next_bin + count
                free += count * capacity
            placed = fill(first, count, capacity, room, length, number, left)
            number, left = number + placed, left - placed

    for room, heap in groups.items():
        for first, count, capacity in heap:
            used = capacity - room
            plan.bins.append((first, count, used, sizes[bisect.bisect_left(sizes, used)]))
    plan.bins.sort()
    plan.segments.sort()
    return plan


def best_size(length, left, sizes, cost, lengths, tokens_upto, free) -> int:
    """The size with the least cost per token expected in a new bin; ties go to the smaller one."""

    def per_token(size: int) -> float:
        own = min(size // length, left) * length
        bins = -(-left // (size // length))
        room = size - own
        shorter = tokens_upto[bisect.bisect_right(lengths, min(room, length - 1))]
        return cost(size) / (own + min(room, max(0, shorter - free) / bins))

    return min((size for size in sizes if size >= length), key=lambda size: (per_token(size), size))


def cut(lengths: DataFrame, doc_id: str, tokens: str, most: int) -> DataFrame:
    """(doc_id, piece, start, length): documents in pieces of at most `most` tokens."""
    n = whole(tokens).cast("bigint")
    rows = lengths.select(whole(doc_id).alias("doc_id"), n.alias("n")).filter("n > 0")
    number = F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(most).cast("bigint")))
    return rows.select("doc_id", "n", number.alias("piece", "start")).select(
        "doc_id", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(most)).cast("int").alias("length")
    )


def pack(
    lengths: DataFrame,
    doc_id: str = "doc_id",
    tokens: str = "n_tokens",
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> DataFrame:
    """One row per piece: doc_id, piece, start (in the document), length, bin_id, bin_offset, capacity.

    `lengths` has a row per document with its number of tokens.
    """
    pieces = reliable(cut(lengths, doc_id, tokens, max(capacities)))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins(counts, capacities, cost)

    # Slots of a length: as many as its pieces ask for, so that no length is numbered in one task.
    rows = max(SLOT_ROWS, sum(counts.values()) // MOST_SLOTS)
    slots_of = [str(max(1, -(-counts.get(length, 0) // rows))) for length in range(1, max(capacities) + 1)]
    slots = F.expr(f"element_at(array({', '.join(slots_of)}), length)")
    slotted = reliable(pieces.withColumn("slot", F.floor(F.rand(0) * slots).cast("int")))
    numbers = Window.partitionBy("length", "slot").orderBy("doc_id", "piece")
    numbered = slotted.withColumn("number", F.row_number().over(numbers) - 1)
    sizes = {(r["length"], r["slot"]): r["n"]
             for r in slotted.groupBy("length", "slot").agg(F.count("*").alias("n")).collect()}
    shifts, before, last = [], 0, None
    for length, slot in sorted(sizes):
        before = 0 if length != last else before
        shifts.append(((length << 32) + slot, before))
        before, last = before + sizes[length, slot], length
    tables = Lookup(plan, shifts)
    shared = lengths.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy()
            bins, offsets, sizes = shared.value.place(get("length"), get("slot"), get("number"))
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length")]
            columns += [pa.array(bins), pa.array(offsets.astype(np.int32)), pa.array(sizes.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = numbered.select("doc_id", "piece", "start", "length").schema
    for name, kind in (("bin_id", "long"), ("bin_offset", "integer"), ("capacity", "integer")):
        schema = schema.add(name, kind)
    return numbered.mapInArrow(run, schema)


class Lookup:
    """The plan as sorted arrays."""

    def __init__(self, plan: Plan, shifts: list[tuple[int, int]]):
        self.segments = np.array(plan.segments, np.int64).reshape(-1, 4)
        self.keys = (self.segments[:, 0] << 48) + self.segments[:, 1]
        self.bins = np.array(plan.bins, np.int64).reshape(-1, 4)
        self.shifts = np.array(shifts, np.int64).reshape(-1, 2)

    def place(self, length: np.ndarray, slot: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bin, place in the bin, capacity) of pieces by length, slot and number in the slot."""
        length = length.astype(np.int64)
        shift = self.shifts[np.searchsorted(self.shifts[:, 0], (length << 32) + slot), 1]
        rank = shift + number
        segment = self.segments[np.searchsorted(self.keys, (length << 48) + rank, side="right") - 1]
        bins = segment[:, 2] + rank - segment[:, 1]
        own = self.bins[np.searchsorted(self.bins[:, 0], bins, side="right") - 1]
        return bins, segment[:, 3], own[:, 3]
