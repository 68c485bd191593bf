"""The quality model: held-out accuracy, tables and awkward rows."""

import zlib

import numpy as np

from marketide.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op9_quality_gam(spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(labels[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([y == p for y, _, p in held]) >= 0.93
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert np.mean([a > b for a in good for b in bad]) >= 0.97


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, len(quality.FEATURES)))
    # The first two features act together only; the third acts alone.
    y = ((x[:, 0] > 0) == (x[:, 1] > 0)).astype(float)
    y = np.where(np.abs(x[:, 2]) > 2, 1.0, y)
    model = quality.fit(x, y)
    assert {(1, 0), (0, 1)} & {(i, j) for i, j, _ in model.pairs}
    assert np.mean((model.score(x) >= 0.5) == y) > 0.9
    row = x[:1]
    total = model.base
    for i, (edges, table) in enumerate(zip(model.edges, model.tables)):
        total += table[np.searchsorted(edges, row[0, i], side="right")]
    for i, j, table in model.pairs:
        a, b = (np.searchsorted(model.pair_edges[k], row[0, k], side="right") for k in (i, j))
        total += table[a, b]
    assert abs(model.score(row)[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_features_do_not_depend_on_neighbours():
    texts = ["", "Some words here.\nSome words here.", "A!! B!! C!!", "x | y | z", "   ", "é" * 50, "one", "\n\n"]
    together = quality.features(texts)
    for i, text in enumerate(texts):
        assert np.array_equal(quality.features([text])[0], together[i]), text
    assert not together[0].any() and np.isfinite(together).all()


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, None), (8, 0, 1), (99, 1, 0), (None, 1, 1), (3, None, 0), (1, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.learn(awkward, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    unlearned = quality.learn(awkward, labels.limit(0))
    assert {r["score"] for r in quality.score(awkward, unlearned).collect()} == {0.5}
    assert quality.score(nothing, model).count() == 0
    again = quality.score(awkward, quality.learn(awkward, labels)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
