import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import hardneg
from tests.llm.tables import with_clashes

VECTORS = "vec_id bigint, embedding array<double>, label int"


def by_definition(rows, is_anchor):
    """The contract, with Python's own integers."""
    rows = [(i, label, [int(np.floor(256 * x)) for x in vec]) for i, vec, label in rows]
    found = []
    for anchor, label, vec in rows:
        if not is_anchor(anchor):
            continue
        scored = sorted((-sum(a * b for a, b in zip(vec, v)), i, own) for i, own, v in rows if i != anchor)
        positives = [(i, -far) for far, i, own in scored if own == label][:5]
        for positive, score in positives:
            inside = [(i, -far) for far, i, own in scored if own != label and 80 * score <= -100 * far <= 100 * score]
            found += [(anchor, positive, rank, i, score, s) for rank, (i, s) in enumerate(inside[:5], 1)]
    return sorted(found)


def found_rows(spark, rows, every=5, **more):
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("id") % every == 0, **more).collect())


@pytest.mark.parametrize("dimension, size, scale", [(6, 80, 1.0), (3, 80, 3000.0), (40, 60, 1e6), (2, 60, 0.01)])
def test_by_brute_force(spark, dimension, size, scale):
    """Scores of a few bits up to 60 bits, of both signs, with ties; parts of seven rows."""
    rng = random.Random(size + dimension)
    centres = [[rng.gauss(0, scale) for _ in range(dimension)] for _ in range(3)]
    rows = [(i, [c + rng.gauss(0, scale / 9) for c in rng.choice(centres)], rng.randrange(3)) for i in range(size)]
    rows += [(size + i, rows[i][1], rng.randrange(3)) for i in range(10)]
    wanted = by_definition(rows, lambda i: i % 5 == 0)
    assert len(wanted) > 20
    assert found_rows(spark, rows, part=7) == wanted
    assert found_rows(spark, rows) == wanted


def test_scores_are_exact_up_to_63_bits():
    rng = np.random.default_rng(1)
    for dimension, top in ((1, 2**31), (7, 2**29), (1500, 2**25), (64, 300)):
        left, right = (rng.integers(-top, top, (9, dimension)) for _ in range(2))
        left[0], right[0], right[1] = top, top, -top
        bound = max(sum(int(x) ** 2 for x in row) for row in [*left, *right])
        primes = hardneg.choose_primes(dimension, bound)
        scores = hardneg.Residues(left, primes).scores(hardneg.Residues(right, primes))
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
        assert scores.tolist() == exact


def test_primes_keep_float32_exact():
    for dimension in (1, 2, 64, 768, 4096):
        primes = hardneg.choose_primes(dimension, 2**62)
        half = (max(primes) - 1) // 2
        assert half * half * min(dimension, hardneg.SLICE) <= hardneg.EXACT
        assert np.prod([float(p) for p in primes]) > 2.0**63


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.85, 0.0], 2), (3, [0.0, 0.0], 2),
        (4, None, 1), (5, [1.0, None], 1), (6, [1.0, float("nan")], 1), (7, [1.0, float("inf")], 1), (8, [], 1),
        (None, [1.0, 0.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1), (11, [1e300, 0.0], 2),
        (12, [0.9, 0.1], 1), (12, [0.9, 0.1], 3),
    ]
    usable = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.85, 0.0], 2), (3, [0.0, 0.0], 2), (12, [0.9, 0.1], 1),
              (12, [0.9, 0.1], 3)]
    df = with_clashes(spark.createDataFrame(rows, VECTORS), ["id", "vec", "row", "part", "positives"])
    found = sorted(tuple(r) for r in hardneg.hard_negatives(df, "id = 0").collect())
    assert found == by_definition(usable, lambda i: i == 0)
    assert {r[3] for r in found} == {2, 12}


def test_no_anchors_and_empty_table(spark):
    assert found_rows(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert found_rows(spark, []) == []
    assert found_rows(spark, [(5, [1.0], 1)]) == []


def test_one_label_holds_most_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.random() + 0.5, rng.random() + 0.5], 0 if i % 9 else 1) for i in range(400)]
    assert found_rows(spark, rows, every=50, part=30) == by_definition(rows, lambda i: i % 50 == 0)
