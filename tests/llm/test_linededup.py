import random

import numpy as np
import pytest

from earshot.llm import linededup
from tests.llm.tables import DOCUMENTS, PROSE, documents, with_clashes


def by_brute_force(texts, min_words):
    """Every run of worded lines with enough words, in order; all but its first copy are deleted."""
    split = [linededup.worded(t) for t in texts]
    seen, gone = set(), [set() for _ in texts]
    runs = []
    for doc, (lines, places, words) in enumerate(split):
        for first in range(len(places)):
            for last in range(first, len(places)):
                if sum(words[first : last + 1]) >= min_words:
                    runs.append((doc, first, last, tuple(lines[p] for p in places[first : last + 1])))
    for doc, first, last, content in runs:
        if content in seen:
            places = split[doc][1]
            gone[doc] |= set(range(places[first], places[last] + 1))
        seen.add(content)
    return [
        None if t is None else "\n".join(line for i, line in enumerate(t.split("\n")) if i not in out)
        for t, out in zip(texts, gone)
    ]


def corpus(seed, docs, kinds):
    rng = random.Random(seed)
    lines = [" ".join(f"w{i}{k}" for k in range(rng.randrange(1, 6))) for i in range(kinds)] + ["", "  "]
    return ["\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 14))) for _ in range(docs)]


@pytest.mark.parametrize("seed, kinds, min_words", [(1, 4, 6), (2, 12, 8), (3, 2, 25), (4, 30, 1)])
def test_by_brute_force(spark, seed, kinds, min_words):
    texts = corpus(seed, 25, kinds)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["c0"]: r["c1"] for r in linededup.dedup_lines(docs, min_words=min_words).collect()}
    assert [found[i] for i in range(len(texts))] == by_brute_force(texts, min_words)


def test_ranks_are_a_suffix_order(spark):
    """Ranks at 2^k lines are equal exactly for equal runs, and sorted as the runs of line ranks are."""
    text = list("abcabcabdabcab")
    lines = spark.createDataFrame([(0, i, ord(c), 0) for i, c in enumerate(text)], "row bigint, at int, h1 bigint, h2 bigint")
    levels = linededup.suffix_ranks(lines, 8)
    for size, level in levels.items():
        ranks = {r["at"]: r["rank"] for r in level.collect()}
        runs = {i: tuple(text[i : i + size]) for i in range(len(text) - size + 1)}
        repeated = {i for i, run in runs.items() if list(runs.values()).count(run) > 1}
        assert set(ranks) == repeated
        for i in repeated:
            for j in repeated:
                assert (ranks[i] < ranks[j]) == (runs[i] < runs[j])


def test_a_level_of_ranks_is_stored_once(spark, monkeypatch):
    """Every table stored between is a file a task, and each file a process that its executor starts."""
    stored = []
    monkeypatch.setattr(linededup, "reliable", lambda df, own=linededup.reliable: stored.append(df.columns) or own(df))
    text = "abcabcabdabcab"
    lines = spark.createDataFrame([(0, i, ord(c), 0) for i, c in enumerate(text)], "row bigint, at int, h1 bigint, h2 bigint")
    levels = linededup.suffix_ranks(lines, 8)
    assert stored == [["row", "at", "rank"]] * len(levels)


def test_shortest_windows():
    assert linededup.windows_of([3, 3, 1, 9], 6).tolist() == [[0, 2], [0, 3], [1, 3], [2, 2], [3, 1]]
    assert linededup.windows_of([1, 1], 6).tolist() == []
    assert np.shape(linededup.windows_of([6], 6)) == (1, 2)


def test_awkward_rows_and_clashing_names(spark):
    docs = with_clashes(documents(spark), ["row", "at", "gone", "n_deleted", "lines"])
    kept = linededup.keep_first_lines(docs, min_words=10)
    assert kept.columns == docs.columns and kept.count() == 11
    texts = [(r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()]
    ones = [t for t in texts if t[0] in (1, 2)]
    assert sorted(ones) == [(1, PROSE, len(PROSE)), (2, "", 0), (2, "", 0)]
    assert {t[1] for t in texts if t[0] in (3, 4)} == {None, ""}


def test_empty_table(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], DOCUMENTS)).count() == 0
