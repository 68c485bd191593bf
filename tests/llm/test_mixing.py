"""Weights by bisection and their realisation by passes over the sources."""

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marketide.llm import mixing, queries


def test_weights_reach_the_entropy():
    tokens = {"a": 100_000, "b": 30_000, "c": 9_000, "d": 0}
    plan = mixing.plan(tokens, evenness=0.9, repeats=100)
    assert abs(mixing.entropy(plan.weights) - 0.9 * math.log(3)) < 1e-9
    assert 0 < plan.exponent < 1 and plan.weights["d"] == 0
    assert abs(sum(plan.weights.values()) - 1) < 1e-12
    for s, t in (("a", "b"), ("b", "c")):
        ratio = plan.weights[s] / plan.weights[t]
        assert math.isclose(ratio, (tokens[s] / tokens[t]) ** plan.exponent, rel_tol=1e-9)


def test_weights_keep_to_the_repetition_limit():
    tokens = {"a": 100_000, "b": 5_000, "c": 700}
    plan = mixing.plan(tokens, evenness=0.99, repeats=3)
    repeats = {s: plan.budgets[s] / n for s, n in tokens.items()}
    assert abs(max(repeats.values()) - 3) < 1e-6 and abs(min(repeats.values()) - 1) < 1e-9
    fixed = mixing.plan(tokens, evenness=0.99, repeats=3, budget=20_000)
    assert abs(sum(fixed.budgets.values()) - 20_000) < 1e-6
    assert max(fixed.budgets[s] / n for s, n in tokens.items()) <= 3 * (1 + 1e-9)


@pytest.mark.parametrize("tokens", [{}, {"a": 5}, {"a": 0, "b": 0}, {"a": 7, "b": 7}])
def test_trivial_sources(tokens):
    plan = mixing.plan(tokens)
    assert plan.exponent == 1.0 and plan.weights.keys() == tokens.keys()


def corpus(spark):
    rows = [(i, "w " * (1 + i % 40), "big" if i % 3 else f"small{i % 4}") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def plain_draws(spark, rows, plan, seed=0):
    """The draws by a plain loop: rows are (doc_id, text_key, source, n_tokens), only the hashes are Spark's."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[2]].append(r)
    out = []
    for source, own in by_source.items():
        total, budget = sum(r[3] for r in own), plan.budgets[source if source is not None else "\0"]
        blocks, left, number = -(-len(own) // mixing.BLOCK_ROWS), budget if total else 0.0, 0
        while left > 1e-9 * total or (total == 0 and number == 0):
            table = spark.createDataFrame(
                [(*r, number, blocks) for r in own],
                "doc_id long, text_key long, source string, n_tokens long, pass int, blocks long",
            )
            order = sorted(
                mixing.dealt(table, seed).collect(),
                key=lambda r: (r["_block"], r["_order"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_key"]),
            )
            at, whole = 0, left >= total * (1 - 1e-9)
            for r in order:
                if whole or at < left:
                    out.append((r["doc_id"], source, r["n_tokens"], number, at))
                at += r["n_tokens"]
            left, number = left - total, number + 1
    return sorted(out, key=repr)


def as_rows(drawn):
    return sorted(((r["doc_id"], r["source"], r["n_tokens"], r["pass"], r["position"]) for r in drawn.collect()), key=repr)


def keyed(spark, docs):
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return [tuple(r) for r in docs.select("doc_id", key, "source", mixing.word_count()).collect()]


@pytest.mark.parametrize("options", [{}, {"budget": 9_000.0}, {"budget": 200_000.0, "repeats": 50}])
def test_draws_equal_a_plain_loop(spark, monkeypatch, options):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    monkeypatch.setattr(mixing, "STRETCH", 4)
    drawn, plan = mixing.draws(corpus(spark), **options)
    got = as_rows(drawn)
    assert got == plain_draws(spark, keyed(spark, corpus(spark)), plan)
    assert got == as_rows(mixing.draws(corpus(spark).repartition(2), **options)[0])
    tokens, largest = defaultdict(int), 40
    orders = defaultdict(list)
    for doc, source, n, number, at in got:
        tokens[source] += n
        orders[source, number].append((at, doc))
    for s, budget in plan.budgets.items():
        assert budget - 1e-6 <= tokens[s] < budget + largest or abs(tokens[s] - budget) < 1e-6
    # Every pass has an order of its own.
    for (s, number), order in orders.items():
        if number and len(order) > 50:
            assert [x for _, x in sorted(order)][:50] != [x for _, x in sorted(orders[s, 0])][:50]


def test_query(spark, documents):
    drawn = queries.op1_source_mix(spark, "/root/testdata/sf0.001")
    assert set(drawn.columns) == {"doc_id", "source", "n_tokens", "pass", "position"}
    rows = drawn.collect()
    assert {r["doc_id"] for r in rows} == documents.keys()
    tokens, used, copies = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, r in documents.items():
        tokens[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    for r in rows:
        used[r["source"]] += r["n_tokens"]
        copies[r["doc_id"]] += 1
    plan = mixing.plan(dict(tokens))
    longest = max(r["n_tokens"] for r in rows)
    assert all(b - 1e-6 <= used[s] <= b + longest for s, b in plan.budgets.items())
    assert max(copies.values()) <= mixing.REPEATS


def test_awkward_rows(spark, awkward, nothing):
    drawn, plan = mixing.draws(awkward)
    assert as_rows(drawn) == plain_draws(spark, keyed(spark, awkward), plan)
    assert "\0" in plan.weights and any(r["source"] is None for r in drawn.collect())
    mixed = mixing.mixed_documents(awkward, repeats=2.0)
    assert mixed.columns == awkward.columns
    rows = mixed.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in awkward.collect()}
    assert sum(r["doc_id"] is None for r in rows) >= 2
    assert mixing.draws(nothing)[0].count() == 0
    assert mixing.mixed_documents(nothing).count() == 0


def test_rounding_makes_no_draw_beyond_the_limit():
    """A budget that is a whole number of passes but for the last digits has no part of a pass."""
    assert mixing._passes(3, 12.000000000012) == (4, 0.0)
    assert mixing._passes(3, 11.999999999999) == (4, 0.0)
    assert mixing._passes(3, 13.0) == (4, 1.0)
    assert mixing._passes(0, 5.0) == (1, 0.0) and mixing._passes(10, 0.0) == (0, 0.0)


def test_no_document_is_drawn_more_often_than_the_limit(spark):
    rows = [(i, "w " * 7, "big") for i in range(900)] + [(1000, "a b c", "small"), (1001, "d e f", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for repeats in (2.0, 3.0, 4.0, 7.0):
        times = mixing.mixed_documents(docs, evenness=1.0, repeats=repeats).groupBy("doc_id").count()
        assert times.agg(F.max("count")).first()[0] == repeats


def test_rows_of_one_doc_id_are_drawn_apart(spark):
    """The same id in a large and in a small source, and twice with other texts in one source."""
    rows = [(i, "w " * 50, "big") for i in range(100)] + [(1, "v " * 50, "small"), (2, "u", "small"), (2, "t", "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn, plan = mixing.draws(docs, repeats=4.0)
    per_row = drawn.groupBy("doc_id", "source", "text_key").count().collect()
    copies = {(r["doc_id"], r["source"]): r["count"] for r in per_row}
    assert copies[1, "big"] == 1 and copies[1, "small"] == 4
    mixed = mixing.mixed_documents(docs, repeats=4.0)
    tokens = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(mixing.word_count()).alias("n")).collect()}
    assert tokens == {s: pytest.approx(b, abs=51) for s, b in plan.budgets.items()}
    again = {(r["doc_id"], r["source"], r["text"]): r["count"] for r in mixed.groupBy("doc_id", "source", "text").count().collect()}
    assert sorted(again.values()) == sorted(r["count"] for r in per_row)
