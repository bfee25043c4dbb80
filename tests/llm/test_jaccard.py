import itertools
import random

import pytest
from pyspark.sql import functions as F

from earshot.llm import jaccard
from tests.llm.tables import DOCUMENTS, documents, with_clashes
from tests.llm.test_simhash import components_of


def by_definition(rows, words, percent):
    """(doc_id, size, component) of (doc_id, text) rows, in any order."""
    sets = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        if len(found) < words:
            sets.append({tuple(found)} - {()})
        else:
            sets.append({tuple(found[i : i + words]) for i in range(len(found) - words + 1)})
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = components_of(range(len(rows)), links)
    smallest = {}
    for place, root in roots.items():
        if rows[place][0] is not None:
            smallest[root] = min(smallest.get(root, rows[place][0]), rows[place][0])
    return sorted(((rows[p][0], len(sets[p]), smallest.get(root)) for p, root in roots.items()), key=repr)


def found_rows(spark, rows, **more):
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), **more)
    assert found.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def near_copies(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def corpus(seed):
    """Bases with copies near the threshold on both sides, chains of copies, shared passages, short texts."""
    rng = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(8):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([12, 40, 150, 400]))]
        texts += [base] * rng.randrange(1, 4)
        for _ in range(8):
            texts.append(near_copies(rng, base, rng.randrange(0, max(2, len(base) // 25))))
        chain = base
        for _ in range(5):
            chain = near_copies(rng, chain, 1)
            texts.append(chain)
        texts.append(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 30))])
    texts += [[rng.choice("ab")] * rng.randrange(1, 4) for _ in range(12)]
    rows = [(i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)) for i, words in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent, share", [(3, 90, 0.2), (5, 80, 0.2), (3, 90, 1.0), (2, 60, 0.02), (1, 100, 0.5)])
def test_by_brute_force(spark, words, percent, share):
    rows = corpus(words + percent)
    wanted = by_definition(rows, words, percent)
    assert len({w[2] for w in wanted}) < len(rows) - 20
    assert found_rows(spark, rows, words=words, percent=percent, share=share) == wanted


def test_one_large_group_of_near_copies(spark):
    """Copies link with the base, most of them not with each other; strangers share most of their words."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    rows += [(i, " ".join(near_copies(rng, base, 1 + i % 3))) for i in range(1, 150)]
    rows += [(i, " ".join(base[:90] + [f"s{i}.{k}" for k in range(20)])) for i in range(150, 220)]
    assert found_rows(spark, rows, words=3, percent=90) == by_definition(rows, 3, 90)


def test_only_a_copy_connects(spark):
    """Two groups meet in one text; the pair is found though their leaders are apart."""
    left, right = [f"l{i}" for i in range(60)], [f"l{i}" for i in range(57)] + ["x1", "x2", "x3"]
    middle = [f"l{i}" for i in range(58)] + ["x1", "x2"]
    rows = [(i, " ".join(t)) for i, t in enumerate([left, left[:59] + ["z"], right, right[:59] + ["y"], middle])]
    assert found_rows(spark, rows, words=1, percent=90) == by_definition(rows, 1, 90)


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), ["id", "node", "root", "size", "tokens", "c1"])
    found = jaccard.near_duplicates(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_definition(rows, 5, 80)


def test_empty_table_and_tables_without_words(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert found_rows(spark, [(1, None), (2, ""), (3, " \n")]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_a_token_moves_once(spark, monkeypatch):
    """Also where more tokens are shared than may be broadcast."""
    monkeypatch.setattr("earshot.llm.common.SMALL_ROWS", 0)
    docs = spark.createDataFrame(corpus(5), "id bigint, text string")
    _, classes = jaccard.classes_of(docs, "text", 3, 90, 0.2)
    plan = jaccard.prefixes(classes, 90)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(token#") == 1


def test_tokens_of_very_many_classes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLED", 2)
    monkeypatch.setattr(jaccard, "KEY_ROWS", 6)
    counted = spark.createDataFrame(
        [(node, token) for node in range(40) for token in (1, 2, 10 + node // 2, 100 + node)], "node bigint, token bigint")
    found = sorted(map(tuple, jaccard.shared_tokens(counted).select("node", "token", "df").collect()))
    assert found == sorted((n, t, df) for n in range(40) for t, df in ((1, 40), (2, 40), (10 + n // 2, 2)))
    assert "BroadcastHashJoin" in jaccard.shared_tokens(counted)._jdf.queryExecution().executedPlan().toString()
    rows = corpus(4)
    assert found_rows(spark, rows, words=3, percent=90) == by_definition(rows, 3, 90)


def test_a_hot_key_is_cut(spark):
    from earshot.llm.common import join_spread

    left = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = join_spread(left, right, ["k"], 50)
    assert found.columns == ["k", "id", "v"]
    assert sorted(map(tuple, found.collect())) == [(0 if i < 900 else i, i, 0 if i < 900 else 2 * i) for i in range(1000)]
