import random

import numpy as np
import pytest

from earshot.llm import packing
from tests.llm.tables import with_clashes


def one_by_one(histogram, sizes):
    """Best fit, one piece after the other; returns what each bin holds."""
    lengths = sorted(histogram)
    upto = np.concatenate([[0], np.cumsum([n * histogram[n] for n in lengths])])
    bins = []
    for length in reversed(lengths):
        opened = None
        for i in range(histogram[length]):
            fitting = [(room, k) for k, (room, _) in enumerate(bins) if room >= length]
            if fitting:
                k = min(fitting)[1]
            else:
                if opened is None:
                    opened = packing.best_size(length, histogram[length] - i, sorted(sizes), packing.sequence_cost,
                                               lengths, upto, sum(room for room, _ in bins))
                bins.append([opened, opened])
                k = len(bins) - 1
            bins[k][0] -= length
    return sorted(size - room for room, size in bins)


def test_plan_is_best_fit():
    rng = random.Random(0)
    for _ in range(300):
        sizes = rng.choice([(16, 32, 64), (10,), (8, 20, 50, 100)])
        histogram = {rng.randrange(1, max(sizes) + 1): rng.randrange(1, 12) for _ in range(rng.randrange(25))}
        plan = packing.plan_bins(histogram, sizes)
        assert sorted(u for _, n, u, _ in plan.bins for _ in range(n)) == one_by_one(histogram, sizes)
        assert all(u <= c and not any(u <= s < c for s in sizes) for _, _, u, c in plan.bins)


def test_plan_does_not_grow_with_the_documents():
    few, many = ({n: 1 + scale * 1000 // (n + 50) for n in range(1, 8193)} for scale in (10, 10_000_000))
    assert len(packing.plan_bins(many).segments) < 3 * len(packing.plan_bins(few).segments)


def check(rows, lengths, sizes):
    bins = {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["length"]
        assert {r["capacity"] for r in own} == {min(s for s in sizes if s >= at)}
    assert sorted(bins) == list(range(len(bins)))
    tokens = {}
    for r in rows:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert tokens == lengths


@pytest.mark.parametrize("slot_rows", [5_000, 3])
def test_pieces_fill_bins(spark, monkeypatch, slot_rows):
    monkeypatch.setattr(packing, "SLOT_ROWS", slot_rows)
    rng = random.Random(4)
    lengths = {i: rng.choice([rng.randrange(1, 40), 7, 7, 7, rng.randrange(1, 400)]) for i in range(500)}
    sizes = (16, 32, 64)
    rows = packing.pack(spark.createDataFrame(list(lengths.items()), "doc_id bigint, n_tokens bigint"),
                        capacities=sizes).collect()
    check(rows, lengths, sizes)
    histogram = {}
    for r in rows:
        histogram[r["length"]] = histogram.get(r["length"], 0) + 1
    used = {}
    for r in rows:
        used[r["bin_id"]] = used.get(r["bin_id"], 0) + r["length"]
    assert sorted(used.values()) == one_by_one(histogram, sizes)


def test_awkward_rows_and_clashing_names(spark):
    rows = [(1, 100), (1, 100), (None, 5), (2, 0), (3, None), (4, -1), (5, 1)]
    lengths = with_clashes(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint"),
                           ["slot", "length", "bin_id", "number", "n"])
    found = packing.pack(lengths, capacities=(8, 16)).collect()
    check(found, {1: 200, None: 5, 5: 1}, (8, 16))
    assert {(r["piece"], r["start"], r["length"]) for r in found if r["doc_id"] == 1} == {
        (i, 16 * i, 16 if i < 6 else 4) for i in range(7)}


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0
