import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import prefixtrie
from tests.llm.tables import with_clashes

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_definition(paths):
    """Rows of all nodes; `paths` maps a conversation to its (role, text) turns."""
    members, children = {}, {}
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(conv)
            if depth:
                children.setdefault(path[: depth - 1], set()).add(path[:depth])

    def below(node):
        yield node
        stack = list(children.get(node, ()))
        while stack:
            node = stack.pop()
            yield node
            stack += children.get(node, ())

    rows = []
    for node, convs in members.items():
        inside = list(below(node))
        ends = ",".join(str(c) for c in sorted(c for c in convs if paths[c] == node))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, ())),
            sum(n not in children for n in inside),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in inside if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def paths_of(rows):
    paths = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=key):
        paths.setdefault(conv, []).append((role or "", text or ""))
    return {conv: tuple(path) for conv, path in paths.items()}


def rebuilt(paths, group=5, most=8):
    made = {}
    for conv, own in paths.items():
        h = zlib.crc32(str(conv).encode()) % (most + 1)
        head = conv - int(np.fmod(conv, group))
        made[conv] = paths.get(head, ())[:h] + own[h:]
    return made


def found_rows(found):
    assert found.columns == COLUMNS
    assert [t for c, t in found.dtypes if c != "ends_sha256"] == ["bigint"] * 7
    return sorted((tuple(r) for r in found.collect()), key=repr)


def plain_trie(spark, rows, **more):
    turns = prefixtrie.number_turns(spark.createDataFrame(rows, TURNS))
    return found_rows(prefixtrie.trie(turns, turns.select("conv"), **more))


def random_turns(seed, convs=60, longest=9, texts=("a", "bb", "é", "")):
    rng = random.Random(seed)
    rows = []
    for conv in range(-5, convs):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("more", [{}, {"segment": 2, "shard": 6}, {"segment": 3, "shard": 1}, {"shard": 17}])
def test_by_brute_force(spark, more):
    rows = random_turns(1)
    assert plain_trie(spark, rows, **more) == by_definition(paths_of(rows))


def test_one_long_and_many_equal_conversations(spark):
    """Deeper than many segments; a third of all conversations are copies; a common first turn."""
    rows = [(1000, t, "user", f"t{t}") for t in range(700)] + [(1001, t, "user", f"t{t}") for t in range(650)]
    for conv in range(60):
        rows += [(conv, 0, "user", "hello"), (conv, 1, "assistant", "hi" if conv % 3 else f"own {conv}")]
    assert plain_trie(spark, rows, segment=64, shard=50) == by_definition(paths_of(rows))


def test_rebuilt_conversations_by_brute_force(spark):
    rows = random_turns(2, longest=14, texts=("a", "b"))
    rows = [r for r in rows if r[0] not in (5, 30)]  # heads that are absent
    turns = prefixtrie.number_turns(spark.createDataFrame(rows, TURNS))
    turns, convs = prefixtrie.with_shared_heads(turns, 5, 8)
    made = rebuilt(paths_of(rows))
    assert any(not path for path in made.values())
    assert found_rows(prefixtrie.trie(turns, convs, shard=20)) == by_definition(made)


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "x"), (1, None, "user", None), (1, 1, None, "y"), (1, 1, None, "y"), (1, 2, "a", "b"),
        (None, 0, "user", "lost"), (2, None, None, None), (3, 0, "user", "long " * 50_000), (4, 0, "us", "erx"),
        (4, 1, "", ""), (5, 0, "user", "x"),
    ]
    df = with_clashes(spark.createDataFrame(rows, TURNS), ["conv", "part", "place", "hash1", "key1"])
    turns = prefixtrie.number_turns(df)
    assert found_rows(prefixtrie.trie(turns, turns.select("conv"))) == by_definition(paths_of(rows))


def test_numbering_over_many_parts(spark):
    """One conversation over all parts, before and behind small ones."""
    rows = [(0, 0, "u", "a"), (0, 1, "u", "a")] + [(1, t % 50, "u", str(t)) for t in range(5000)] + [(2, 0, "u", "b")]
    turns = prefixtrie.number_turns(spark.createDataFrame(rows, TURNS).repartition(7))
    counts = {r["conv"]: sorted(r["places"]) for r in
              turns.groupBy("conv").agg(F.collect_list("place").alias("places")).collect()}
    assert counts == {0: [1, 2], 1: list(range(1, 5001)), 2: [1]}


def test_empty_table(spark):
    assert plain_trie(spark, []) == []


@pytest.mark.parametrize("block", [1, 2, 8, 512])
def test_findclose(block):
    rng = random.Random(block)
    for _ in range(30):
        bits, open_now = [], 0
        for _ in range(rng.randrange(1, 200)):
            if open_now and rng.random() < 0.45:
                bits.append(0)
                open_now -= 1
            else:
                bits.append(1)
                open_now += 1
        bits += [0] * open_now
        stack, wanted = [], {}
        for at, bit in enumerate(bits):
            if bit:
                stack.append(at)
            else:
                wanted[stack.pop()] = at
        opens = np.flatnonzero(bits)
        found = prefixtrie.RangeMinMax(np.array(bits, np.int8), block).findclose(opens)
        assert found.tolist() == [wanted[o] for o in opens.tolist()]
