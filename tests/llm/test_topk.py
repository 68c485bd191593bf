"""Exact top-k search against brute force over all pairs."""

import math

import numpy as np
import pytest

from marketide.llm import blocks, topk
from marketide.llm.queries import op11_exact_topk

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, score double, block string, v string"


def whole(v, scale):
    return [math.floor(scale * x) if abs(x) < 1e15 else int(x) * scale for x in v]


def clipped(x):
    return max(-(2**63), min(2**63 - 1, x))


def brute(rows, every, k, scale):
    """rows: vec_id -> vector."""
    plain = {
        i: [clipped(x) for x in whole(v, scale)] for i, v in rows.items()
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, q in plain.items():
        if i % every:
            continue
        scores = [(-clipped(sum(a * b for a, b in zip(q, v))), j) for j, v in plain.items() if j != i and len(v) == len(q)]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(df):
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, "x", "y") for i, v in rows], SCHEMA)


def spread_rows(n=700, seed=3):
    """Lengths over three orders of magnitude, and tight clusters, so that every way of pruning is taken."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, n)] + 0.02 * rng.normal(size=(n, 16))
    x *= np.exp(rng.normal(size=(n, 1)) * 1.5) / 4
    x[5:30] = x[5]
    return dict(enumerate(x.tolist()))


@pytest.mark.parametrize("growth", [1, 16])
def test_brute_force(spark, growth):
    rows = spread_rows()
    got = found(topk.top_k(frame(spark, rows.items()), 10, 7, 1024, bucket_rows=60, growth=growth))
    assert got == brute(rows, 10, 7, 1024)


def test_awkward(spark):
    inf, nan = math.inf, math.nan
    rows = {
        0: [1.0, 2.0], 1: [0.0, 0.0], 2: [-3.0, 0.5], 3: None, 4: [nan, 1.0], 5: [inf, 0.0], 6: [1.0, None],
        10: [], 11: [], 12: [0.5], 20: [1e300, -1e300], 21: [1e17, 1e17], 22: [-1e17, 3.0], 30: [2e15, 1.0],
        40: [0.0, 0.0], 50: [0.25, 0.75, 1.0], 60: [0.9995, 1.0], 61: [1.0, 2.0],
    }
    shared = list(rows.items()) + [(61, [1.0, 2.0]), (None, [1.0, 1.0]), (70, [1.0, 2.0]), (70, [0.5, 2.0])]
    got = found(topk.top_k(frame(spark, shared), 10, 3, 1024, bucket_rows=4))
    assert got == brute({**rows, 70: [0.5, 2.0]}, 10, 3, 1024)
    assert not any(q == 50 for q, *_ in got)


def test_ties_and_few(spark):
    rows = {i: [1.0, 0.0] for i in range(400)}
    got = found(topk.top_k(frame(spark, rows.items()), 100, 5, 16, bucket_rows=30))
    assert got == [(q, r, j, 256) for q in (0, 100, 200, 300) for r, j in enumerate([j for j in range(6) if j != q][:5], 1)]
    assert found(topk.top_k(frame(spark, [(0, [1.0]), (1, [2.0])]))) == [(0, 1, 1, 1024 * 2048)]
    assert found(topk.top_k(frame(spark, [(0, [1.0])]))) == []
    assert found(topk.top_k(frame(spark, []))) == []


def test_coordinates_prune_but_lose_nothing():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * (rng.normal(size=(30, 1, 24)) + 0.05 * rng.normal(size=(30, 40, 24))).reshape(-1, 24)).astype(np.int64)
    bucket = topk.Bucket(np.arange(len(x)), x)
    looked_at = 0
    for q in x[::97].astype(float):
        unit = q / np.linalg.norm(q)
        for cosine in (0.8, 0.95, 0.999, 1.0):
            at = bucket.within(unit, cosine)
            near = np.flatnonzero(bucket.units @ unit >= cosine)
            assert set(near) <= set(at)
            looked_at += len(at)
    assert looked_at < 0.2 * 4 * 13 * len(x)


@pytest.mark.parametrize("size", [10, 10**6, 10**12, 10**18])
def test_products(size):
    rng = np.random.default_rng(size % 97)
    a, b = (rng.integers(-size, size, (n, 5)) for n in (3, 4))
    reach = float(blocks.lengths_of(a).max() * blocks.lengths_of(b).max())
    expected = [[clipped(sum(int(x) * int(y) for x, y in zip(r, s))) for s in b] for r in a]
    assert blocks.products(a, b, reach).tolist() == expected


def test_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    assert found(op11_exact_topk(spark, SMALL)) == brute({r["vec_id"]: r["embedding"] for r in table}, 100, 10, 1024)
