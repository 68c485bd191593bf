"""Hard negatives against brute force, and the residue products against whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketide.llm import blocks, mining
from marketide.llm.queries import op12_hard_negatives

from test_topk import clipped, whole

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, rank int, block string, nth string"
COLUMNS = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95, scale=256):
    """rows: (vec_id, vector, label); one per vec_id."""
    plain = {
        i: ([clipped(x) for x in whole(v, scale)], label) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a, (q, label) in plain.items():
        if a % every:
            continue
        scores = sorted(
            (-clipped(sum(x * y for x, y in zip(q, v))), i, other) for i, (v, other) in plain.items() if i != a and len(v) == len(q)
        )
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            inside = [(-s, j) for s, j, other in scores if other != label and low * -p <= 100 * -s <= high * -p]
            out += [(a, i, rank, j, -p, s) for rank, (s, j) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(df):
    kinds = {c: "int" if c == "rank" else "bigint" for c in COLUMNS}
    assert dict(df.dtypes) == kinds
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", "y") for i, v, label in rows], SCHEMA)


def random_rows(n=500, d=9, seed=4):
    """A third of the rows have one label; some vectors occur many times."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * 0.4
    x[rng.integers(0, n, 90)] = x[7]
    labels = np.where(rng.random(n) < 0.33, 3, rng.integers(0, 40, n))
    return [(i, v, label) for i, (v, label) in enumerate(zip(x.tolist(), labels.tolist()))]


@pytest.mark.parametrize("size", [37, 4096])
def test_brute_force(spark, size):
    rows = random_rows()
    expected = brute(rows, every=10)
    assert len(expected) > 300
    assert found(mining.hard_negatives(frame(spark, rows), every=10, block_rows=size)) == expected


def test_awkward(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (2, [0.9, 1.7], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf, 0.0], 2),
        (6, [1.0, None], 2), (7, [1.0, 1.5], None), (8, [], 1), (9, [], 2), (50, [], 1), (51, [0.5], 2),
        (100, [-1.0, -1.0], 4), (101, [1.0, 1.0], 4), (102, [1.0, 1.1], 5), (150, [0.0, 0.0], 6), (151, [1.0, 1.0], 6),
        (200, [1e300, 1e17], 7), (201, [1e300, 1e16], 7), (202, [1e13, 1e12], 8), (250, [9.0, 9.0], -5),
    ]
    shared = rows + [(2, [0.9, 1.7], 2), (None, [1.0, 1.0], 1), (1, [1.0, 1.9], 3)]
    got = found(mining.hard_negatives(frame(spark, shared), block_rows=4))
    assert got == brute(rows)
    assert {r[0] for r in got} >= {0, 50, 150}
    assert found(mining.hard_negatives(frame(spark, []))) == []
    assert found(mining.hard_negatives(frame(spark, rows[:1]))) == []


@pytest.mark.parametrize("size,d", [(3, 1), (256, 64), (256, 200), (10**5, 33), (10**8, 70), (7 * 10**8, 2), (10**18, 3)])
def test_residues(size, d):
    rng = np.random.default_rng(d)
    a, b = (rng.integers(-size, size + 1, (n, d)) for n in (5, 6))
    a[0], b[0], b[1] = size, size, -size
    expected = [[clipped(sum(int(x) * int(y) for x, y in zip(r, s))) for s in b] for r in a]
    assert mining.Residues(a).scores(mining.Residues(b)).tolist() == expected


def test_moduli():
    assert mining.CHUNK * ((mining.LARGEST - 1) // 2) ** 2 < 2**24
    assert mining.moduli(100.0) == [1021]
    product = math.prod(mining.moduli(blocks.FITS))
    assert product > 2 * blocks.FITS


@pytest.mark.parametrize("positive", [-7, 0, 1, 2, 19, 100, 101, 12345, 2**62 + 3])
def test_windows(positive):
    least, most = (int(v[0]) for v in mining.windows(np.array([positive]), 50, 95))
    for edge in (least, most):
        inside = [s for s in range(edge - 2, edge + 3) if 50 * positive <= 100 * s <= 95 * positive]
        assert inside == [s for s in range(edge - 2, edge + 3) if least <= s <= most]


def test_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in table]
    expected = brute(rows)
    assert found(op12_hard_negatives(spark, SMALL)) == expected and len(expected) > 50
