import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from earshot.llm import simhash
from tests.llm.tables import DOCUMENTS, LONG, PROSE, documents, rows_of, with_clashes


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def near(fps, radius):
    return [(a, b) for a, b in itertools.combinations(fps, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= radius]


def test_fingerprint_by_definition():
    text = "Über ONE two\tTHREE four\x0bfive five five"
    words = text.replace("ONE", "one").replace("THREE", "three").split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) % 2**64 == wanted
    assert simhash.fingerprint("A b") % 2**64 == xxhash.xxh64(b"a b", seed=42).intdigest()
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_tables_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for places in itertools.combinations(range(64), radius):
        differing = sum(1 << p for p in places)
        assert any(mask & differing == 0 for mask in masks)
    for mask in masks:
        for places in itertools.combinations(range(0, 64, 3), radius):
            differing = sum(1 << p for p in places)
            if not mask & differing:
                assert any(block & differing == 0 for block in simhash.block_masks(mask, radius))


def test_spark_hash_is_not_needed_to_agree(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % 2**64 == xxhash.xxh64(b"a b", seed=42).intdigest()


@pytest.mark.parametrize("bucket", [2048, 3])
def test_links_and_components_by_brute_force(spark, bucket):
    """Chains, stars and strangers; with small buckets everything goes through the second cut."""
    rng = random.Random(1)
    fps = {0, 2**64 - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(10):
            fps.add(centre)
            centre ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        fps |= {centre ^ 1 << rng.randrange(64) for _ in range(5)}
    fps = sorted(simhash.signed(f) for f in fps)
    links = simhash.links_within(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 2, bucket)
    found = [tuple(r) for r in links.collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in found)
    wanted = components_of(fps, near(fps, 2))
    assert components_of(fps, found) == wanted
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert {f: roots.get(f, f) for f in fps} == wanted


def test_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a bigint, b bigint")
    assert {tuple(r) for r in simhash.components(links).collect()} == {(i, 0) for i in range(n + 1)} | {
        (1000, 1000), (1001, 1000)}


def test_awkward_rows(spark):
    found = simhash.near_duplicates(with_clashes(documents(spark), ["fp", "root", "component_id", "first_id"]))
    groups = {}
    for row in found.collect():
        groups.setdefault(row["component_id"], []).append(row["doc_id"])
    assert sorted(groups[1]) == [1, 2, 2]
    # null, empty and blank texts, with the null id, share the fingerprint zero
    assert sorted(groups[3], key=repr) == [3, 4, 5, None]
    assert sum(map(len, groups.values())) == 11


def test_one_document_stays(spark):
    docs = with_clashes(documents(spark), ["fp", "root", "c0"])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    near_text = PROSE + " And more of it."
    fp = [simhash.fingerprint(t) for t in (PROSE, near_text)]
    alone = bin((fp[0] ^ fp[1]) & (2**64 - 1)).count("1") > 2
    wanted = [1, 3, 6, 7, 8] + [None] * alone
    assert [r[0] for r in rows_of(kept, "doc_id")] == sorted(wanted, key=lambda x: repr((x,)))
    assert kept.filter("doc_id = 6").first()["text"] == LONG


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_forest_reaches_all():
    values = np.array([0, 1, 3, 7, 15, 3 << 40], np.uint64)
    links = simhash.forest(values, 1)
    assert len(links) == 4 and len(set(components_of(values.tolist(), links).values())) == 2
