"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from marketide.llm import ann, queries

FOLDER = "/root/testdata/sf0.01"


def brute(vectors, every, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        score[i] = -np.inf
        top = np.lexsort((ids, -score))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in top if np.isfinite(score[j])]
    return out


def grouped(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


def recall(found, expected):
    return np.mean([
        len({v for v, *_ in found.get(q, [])} & {v for v, _ in want}) / len(want) for q, want in expected.items() if want
    ])


def test_query(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    expected = brute(vectors, 50, 5)
    found = grouped(queries.op6_hilbert_neighbours(spark, FOLDER))
    assert found.keys() == expected.keys()
    assert recall(found, expected) >= 0.9
    for q, rows in found.items():
        assert [r for *_, r in rows] == [1, 2, 3, 4, 5]
        for v, score, _ in rows:
            a, b = np.array(vectors[q], float), np.array(vectors[v], float)
            assert math.isclose(score, a @ b / np.linalg.norm(a) / np.linalg.norm(b), rel_tol=1e-12)


def test_recall_with_many_more_rows_than_a_block(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 32))
    x = centres[rng.integers(0, 12, 8000)] + 0.7 * rng.normal(size=(8000, 32))
    vectors = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    assert recall(grouped(ann.nearest(df, every=100)), brute(vectors, 100, 5)) >= 0.9


def test_curve_visits_every_cell_in_steps_of_one():
    bits, dims = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = ann.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * dims))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, []), (None, [1.0, 0.0]), (50, [0.0, 3.0]), (50, [0.0, 3.0]), (100, [1e300, 1e300]), (9, [-1e-300, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, key string")
    found = grouped(ann.nearest(df))
    assert found.keys() == {0, 50, 100}
    # Equal cosines: the smaller id first; all candidates if there are no more.
    assert [v for v, *_ in found[50]][:2] == [1, 2] and len(found[50]) == 5
    assert len(found[0]) == 5
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("n", [20_000, 60_000, 240_000])
def test_recall_of_the_windows_without_clusters(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asked = rng.choice(n, 40, replace=False)
    score = x[asked] @ x.T
    score[np.arange(40), asked] = -1
    nearest = np.argpartition(-score, 5, axis=1)[:, :5]
    size, reach = ann.window(n)
    met = np.zeros(nearest.shape, bool)
    for ordering in range(ann.ORDERINGS):
        rank = np.empty(n, np.int64)
        rank[np.lexsort(ann.curve_keys(x, np.arange(n), ordering)[::-1])] = np.arange(n)
        met |= np.abs(rank[nearest] // size - rank[asked][:, None] // size) <= reach
    assert met.mean() >= 0.9


def test_window_grows_by_larger_blocks_and_then_by_more():
    assert ann.window(0) == ann.window(1000) == (512, 1)
    for n in (10**6, 10**7, 10**9):
        size, reach = ann.window(n)
        assert size <= ann.MOST_BLOCK and size * reach >= n / ann.SHARE


def test_several_blocks_within_reach(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 8)
    monkeypatch.setattr(ann, "MOST_BLOCK", 16)
    monkeypatch.setattr(ann, "AT_ONCE", 64)
    x = np.random.default_rng(5).normal(size=(6000, 32))
    vectors = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    assert recall(grouped(ann.nearest(df, every=200)), brute(vectors, 200, 5)) >= 0.9


def test_more_copies_and_near_copies_than_the_windows_hold(spark):
    rng = np.random.default_rng(9)
    copies, near = rng.normal(size=(2, 32))
    x = rng.normal(size=(12_000, 32))
    kind = rng.integers(0, 3, len(x))
    x[kind == 0] = copies
    x[kind == 1] = near + 1e-3 * rng.normal(size=((kind == 1).sum(), 32))
    x[np.flatnonzero(kind == 0)[::2]] *= 4.0
    vectors = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    found = grouped(ann.nearest(df, every=60))
    smallest = np.flatnonzero(kind == 0)[:6].tolist()
    asked = [q for q in range(0, len(x), 60)]
    assert found.keys() == set(asked)
    for q in asked:
        if kind[q] == 0:
            assert [v for v, *_ in found[q]] == [v for v in smallest if v != q][:5]
    expected = brute(vectors, 60, 5)
    assert recall(found, {q: expected[q] for q in asked if kind[q] == 1}) >= 0.9
