import numpy as np
import pytest

from earshot.llm import ann
from tests.conftest import SF_DIR
from tests.llm.tables import with_clashes

VECTORS = "vec_id bigint, embedding array<float>"
QUERY = "id % 20 = 0"


def exact(rows, k=20):
    found = {}
    for q, v in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)
            found[q] = [(i, -s) for s, i in scored[:k]]
    return found


def grouped(found):
    lists = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = lists.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return lists


def test_hadamard_is_orthonormal():
    rows = np.eye(16)
    turned = ann.hadamard(rows)
    assert np.allclose(turned @ turned.T, rows) and np.allclose(np.abs(turned), 0.25)


@pytest.mark.parametrize("functions", [1, 2])
def test_first_probe_is_the_own_bucket(functions):
    vectors = np.random.default_rng(0).normal(size=(50, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    hasher = ann.Hasher(12, 1.0, 3, functions)
    codes, probes = hasher.codes(vectors), hasher.probes(vectors, 40)
    assert (probes[:, :, 0] == codes).mean() > 0.97  # but for axes as near as rounding
    assert all(len(set(p[p >= 0])) == (p >= 0).sum() for row in probes for p in row)


def test_recall(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    wanted = exact([(r["vec_id"], np.array(r["embedding"], float)) for r in vectors.collect()])
    found = grouped(ann.nearest(vectors, QUERY))
    assert set(found) == set(wanted)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    scores = {(q, i): s for q, own in exact([(r["vec_id"], np.array(r["embedding"], float)) for r in vectors.collect()],
                                             10**6).items() for i, s in own}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, own in found.items() for i, s in own)


@pytest.mark.parametrize("bucket", [4096, 16])
def test_exact_when_all_buckets_are_probed(spark, bucket):
    """Different norms, ties, copies, small buckets cut into parts: with every probe the search is exact."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 5).astype(float)) for i in range(300)]
    rows = [(i, v if v.any() else np.ones(5)) for i, v in rows]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], VECTORS)
    found = grouped(ann.nearest(df, QUERY, target=1.0, tune_queries=1000, bucket=bucket))
    assert found == exact(rows)


@pytest.mark.parametrize("probes, tables", [(64, 12), (4, 6)])
def test_hard_vectors(spark, monkeypatch, probes, tables):
    """Weak neighbours and two rotations: where the caps do not reach the recall, fewer rotations or all rows do.

    The recall is that of queries which had no part in the tuning.
    """
    monkeypatch.setattr(ann, "MOST_PROBES", probes)
    monkeypatch.setattr(ann, "MOST_TABLES", tables)
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(4000, 48)))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], VECTORS)
    hasher = ann.Hasher(48, 12.0, 6, 2)
    classes = ann.classes_of(df, "vec_id", "embedding", 21).cache()
    needed = ann.probes_for(hasher, np.array([v for _, v in rows[:20]]), np.array([v for _, v in rows[20:40]]),
                            np.arange(20), 1.0)
    assert needed.shape == (6,) and (needed > hasher.most).all()  # the first tables cannot do it
    found_hasher, count = ann.tuned(classes, classes.filter("first % 20 = 0"), hasher, 0.95, 50)
    assert count <= found_hasher.most and found_hasher.functions == 1
    wanted, found = exact(rows), grouped(ann.nearest(df, QUERY, bucket=16, tune_queries=50, tables=6))
    asked = {r["first"] for r in classes.filter("first % 20 = 0").orderBy(ann.F.xxhash64("vec"), "cid").limit(50).collect()}
    rest = [q for q in wanted if q not in asked]
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in rest)
    assert len(rest) == 150 and hits >= 0.9 * 20 * len(rest)


def test_blocks_of_queries_probe_alike(monkeypatch):
    hasher = ann.Hasher(20, 5.0, 3, 2)
    vectors = np.random.default_rng(1).normal(size=(70, 20))
    whole = hasher.probes(vectors, 30)
    monkeypatch.setattr(ann, "PROBED", 2000)
    blocks = hasher.blocks(70, 30)
    assert len(blocks) > 5 and (np.concatenate([hasher.probes(vectors[b], 30) for b in blocks]) == whole).all()
    assert ann._lists(whole).to_pylist() == whole.tolist()


def test_large_norms_rank_by_exact_sums():
    scores = np.array([[1e12, 1e12 + 1e-3, 1e12 - 1e-3, 0.0]])
    assert [places.tolist() for places in ann.best_rows(scores, 1, 1e12)] == [[0, 0, 0], [0, 1, 2]]


def test_probes_needed_by_number_of_tables():
    rng = np.random.default_rng(2)
    queries, near, of = rng.normal(size=(10, 20)), rng.normal(size=(40, 20)), np.repeat(np.arange(10), 4)
    hasher = ann.Hasher(20, 8.0, 5, 1)
    probes, codes = hasher.probes(queries, hasher.most), hasher.codes(near)
    needed = ann.probes_for(hasher, queries, near, of, 0.9)
    for tables in range(1, 6):
        def found(count):
            return sum(any(codes[i, t] in probes[of[i], t, :count] for t in range(tables)) for i in range(40))
        count = int(needed[tables - 1])
        assert found(count) >= 36 > found(count - 1)


@pytest.mark.parametrize("held", [1 << 19, 40, 1])
def test_finds_are_merged_in_any_order(monkeypatch, held):
    """Buckets of several tables, few finds held at a time: the best of each query, each class once."""
    monkeypatch.setattr(ann, "HELD", held)
    monkeypatch.setattr(ann, "SUMMED", 7)
    rng = np.random.default_rng(4)
    points, queries = rng.integers(-2, 3, (90, 4)).astype(float), rng.integers(-2, 3, (9, 4)).astype(float)
    state, flushed = ann.Bucket(4, 5), []
    for table in range(3):
        for bucket in range(4):
            own = np.flatnonzero(rng.integers(0, 4, 90) == 0)
            for cut in np.array_split(own, 2):
                state.add((table, bucket, 0, 0), cut, cut + 1000, points[cut])
            state.add((table, bucket, 0, 1), np.arange(200, 209), np.arange(9), queries)
            seen = set(own.tolist()) if table == bucket == 0 else seen | set(own.tolist())
            if state.full():
                flushed += state.flush().to_pylist()
    flushed += state.flush().to_pylist()
    for query in range(9):
        rows = {(-r["score"], r["first"], r["cid"]) for r in flushed if r["query"] == 200 + query}
        wanted = sorted((-float(points[i] @ queries[query]), i + 1000, i) for i in seen)[:5]
        assert sorted(rows)[:5] == wanted
    assert state.held == 0 and state.flush().num_rows == 0


def test_awkward_rows_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [2.0, 0.0]), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
            (40, None), (60, [0.0, 0.0])]
    df = with_clashes(spark.createDataFrame(rows, VECTORS), ["id", "vec", "cid", "score", "rank"])
    found = grouped(ann.nearest(df, QUERY, target=1.0))
    assert found == {0: [(20, 2.0), (3, 0.5)], 20: [(0, 2.0), (3, 1.0)]}


def test_hardly_any_rows(spark):
    assert ann.nearest(spark.createDataFrame([], VECTORS), QUERY).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0])], VECTORS), QUERY).count() == 0
    assert ann.nearest(spark.createDataFrame([(1, [1.0]), (2, [2.0])], VECTORS), QUERY).count() == 0
