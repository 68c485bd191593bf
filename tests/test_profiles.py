"""Encoders and data-quality profiles."""

import pytest
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from helpers import d, retail, rows
from marketide.operators import encode, quality
from marketide.operators.skew import Spread
from marketide.session import materialise



@pytest.fixture(scope="module")
def tables(spark):
    return retail(spark)


def test_ordinal(spark):
    df = spark.createDataFrame([("S",), ("XXL",), ("huge",), (None,)], "size string")
    assert rows(encode.ordinal(df, "size", encode.SIZE_CODES, "code")) == [
        ("S", 1), ("XXL", 5), ("huge", 0), (None, 0)
    ]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    got = encode.one_hot(df, ["k"])
    assert got.columns == ["id", "k_a", "k_b"]
    assert rows(got) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert encode.one_hot(df, {"k": ["b"]}, keep=True).columns == ["id", "k", "k_b"]


def test_sparse_one_hot_spread_out_equals_one_hot(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (2, "b", None), (3, None, None), (4, "new", 5), (5, "a", 5)], "id int, k string, n int"
    )
    dictionary = encode.label_dictionary(df.where("id < 4"), ["n", "k"])
    assert rows(dictionary) == [("k", "a", 0), ("k", "b", 1), ("n", "3", 2)]
    forced = Spread(above_bytes=0, rows_per_task=1, broadcast_small=False)
    for spread in (Spread(), forced):
        sparse = encode.one_hot_sparse(df, ["k", "n"], dictionary, keep=True, spread=spread)
        assert rows(sparse.select("id", "label_ids")) == [(1, [0, 2]), (2, [1]), (3, []), (4, []), (5, [0])]
    wide = encode.dense(sparse, "label_ids", dictionary, {"k": ["a", "b", "unheard"], "n": ["3"]})
    expected = encode.one_hot(df, {"k": ["a", "b", "unheard"], "n": ["3"]}, keep=True)
    assert wide.columns == expected.columns and rows(wide) == rows(expected)
    assert encode.label_dictionary(df.where("false"), ["k"]).count() == 0


def test_a_hundred_thousand_labels(spark):
    df = spark.range(300_000).select("id", F.concat(F.lit("label "), F.col("id") % 100_000).alias("k"))
    dictionary = materialise(encode.label_dictionary(df, ["k"]))
    figures = dictionary.agg(F.count("*"), F.min("label_id"), F.max("label_id"), F.count_distinct("label_id")).first()
    assert tuple(figures) == (100_000, 0, 99_999, 100_000)
    sparse = encode.one_hot_sparse(df, ["k"], dictionary)
    assert sparse.where("size(label_ids) = 1").count() == 300_000
    wide = encode.dense(sparse, "label_ids", dictionary, {"k": ["label 7", "label 99999"]})
    assert wide.agg(F.sum("k_label 7"), F.sum("k_label 99999")).first() == (3, 3)


def test_frequency_rank_orders_count_then_label(spark):
    labels = ["b"] * 2 + ["a"] * 2 + ["ab"] * 2 + ["c"] * 5 + [None] * 2 + ["zz", "za", "z"]
    df = spark.createDataFrame([(x,) for x in labels], "city string")
    counts = {x: labels.count(x) for x in set(labels)}
    order = sorted(counts, key=lambda x: (counts[x], x is not None, x or ""))
    got = {r.city: r["rank"] for r in encode.frequency_rank(df, "city").collect()}
    assert got == {x: i for i, x in enumerate(order, start=1)}
    eager = Spread(above_bytes=0, rows_per_task=2, broadcast_small=False)
    for spread in (Spread(), eager):
        coded = [r.city for r in encode.rank_encode(df, "city", spread).collect()]
        assert sorted(coded) == sorted(order.index(x) + 1 for x in labels)


def test_encoded_tables(tables):
    products = encode.encode_products(tables["products"])
    assert "category_Streetwear" in products.columns and "color" not in products.columns
    assert {r.product_id: r["size"] for r in products.collect()} == {10: 2, 11: 4, 12: 0}
    promotions = encode.encode_promotions(tables["promotions"])
    assert "promo_channel_email" in promotions.columns
    assert encode.fill_category(tables["promotions"]).where("applicable_category = 'all_categories'").count() == 1
    customers = encode.encode_customers(tables["customers"])
    assert sorted(r.age_group for r in customers.collect()) == [0, 1, 5]
    assert "region_North" in encode.encode_geography(tables["geography"]).columns


def test_labels_that_begin_alike_are_ranked_in_many_tasks(spark):
    df = spark.range(4000).select(F.concat(F.lit("customer_"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = encode.frequency_rank(df, "k")
        got = {r.k: r["rank"] for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {f"customer_{i:06d}": i + 1 for i in range(4000)}


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 7.0), (3.0, 12.0)], "a double, b double")
    got = encode.scaled(df, ["a", "b"]).select(vector_to_array("features")[0].alias("x"))
    assert sorted(r.x for r in got.collect()) == pytest.approx([-1.5**0.5, 0.0, 1.5**0.5])


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, 1.0), (3, None)], "a int, b double")
    got = rows(quality.null_profile({"t": df, "empty": df.limit(0)}))
    assert ("t", "a", 1, 3) in got and ("t", "b", 2, 3) in got and ("empty", "a", 0, 0) in got


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(quality.duplicate_profile({"t": df})) == [("t", 4, 2)]


def test_reconciliation_equals_joining(tables):
    pair = ["order_id", "product_id"]
    steps = [("orders", tables["orders"], ["order_id"]), ("returns", tables["returns"], pair),
             ("reviews", tables["reviews"], pair)]
    joined, expected = tables["order_items"], [tables["order_items"].count()]
    for _, right, on in steps:
        joined = joined.join(right.select(*on), on, "left")
        expected.append(joined.count())
    got = quality.join_reconciliation(tables["order_items"], steps)
    assert [r.n_rows for r in got.orderBy("step").collect()] == expected


def test_cardinality_and_frequencies(tables):
    products = tables["products"]
    got = {r.column_name: (r.n_unique, r.n_null) for r in
           quality.cardinality_profile(products, ["category", "color"]).collect()}
    assert got == {"category": (2, 0), "color": (2, 1)}
    rough = quality.cardinality_profile(products, ["category"], approximate=True)
    assert rough.first().n_unique == 2
    assert ("color", "red", 1) in rows(quality.value_counts(products, ["color"]))
    assert len(rows(quality.value_counts(products, ["color"], dropna=False))) == 3
    ordered = [tuple(r) for r in quality.frequency_with_null(products, "category").collect()]
    assert ordered == [("Streetwear", 2), ("Outdoor", 1)]


def test_summary_and_preview(tables):
    got = rows(quality.table_summary({"orders": (tables["orders"], "order_date"), "p": (tables["products"], None)}))
    assert got == [("orders", 6, 5, d("2020-01-01"), d("2020-03-01")), ("p", 3, 8, None, None)]
    last = quality.preview(tables["orders"].select("order_id"), 2, "order_id", last=True)
    assert [r[0] for r in last.collect()] == [6, 5]
    assert quality.preview(tables["orders"], 3).count() == 3


def test_duplicates_where_fingerprints_clash(spark):
    """With one fingerprint for all rows the full rows decide; missing values count by their place."""
    table = spark.createDataFrame(
        [(1, None, 0.0), (1, None, -0.0), (None, 1, float("nan")), (None, 1, float("nan")), (1, 1, None), (2, None, 0.0)],
        "a int, b int, c double",
    )
    same = lambda df: [F.lit(7).cast("long"), F.lit(8).cast("long")]
    for got in (quality.duplicate_profile({"t": table}), quality.duplicate_profile({"t": table}, fingerprint=same)):
        assert rows(got) == [("t", 6, 2)]
    assert rows(quality.duplicate_profile({"t": table.where("false")})) == [("t", 0, 0)]


def test_unique_rows_shuffle_their_fingerprints_alone(spark):
    table = spark.range(1000).withColumn("text", F.repeat(F.lit("long text"), 50))
    plan = quality.duplicate_profile({"t": table})._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan  # the repeated fingerprints, written once
    assert rows(quality.duplicate_profile({"t": table.union(table.where("id < 5"))})) == [("t", 1005, 5)]


def test_reconciliation_with_hot_keys(spark):
    """A third of the lines under one promotion, a fifth in one order, lines without keys."""
    lines = [(0 if i % 5 == 0 else i, i % 7, "P" if i % 3 == 0 else None if i % 3 == 1 else f"p{i}") for i in range(900)]
    lines += [(None, 1, "P"), (3, None, "P")]
    base = spark.createDataFrame(lines, "order_id int, product_id int, promo_id string")
    orders = spark.createDataFrame([(i,) for i in range(0, 900, 2)] + [(0,)], "order_id int")
    returns = spark.createDataFrame([(0, 3), (0, 3), (4, 4), (None, 1)], "order_id int, product_id int")
    promotions = spark.createDataFrame([("P",), ("P",), ("p2",), (None,)], "promo_id string")
    steps = [("orders", orders, ["order_id"]), ("returns", returns, ["order_id", "product_id"]),
             ("again", orders.distinct(), ["order_id"]), ("promotions", promotions, ["promo_id"])]
    joined, expected = base, [(0, "base", base.count(), base.count())]
    for i, (name, right, on) in enumerate(steps, 1):
        marked = joined.join(right.withColumn(f"m{i}", F.lit(1)), on, "left")
        joined = marked
        expected.append((i, name, joined.count(), joined.where(f"m{i} = 1").count()))
    forced = Spread(above_bytes=0, rows_per_task=50, broadcast_small=False)
    assert rows(quality.join_reconciliation(base, steps)) == sorted(expected)
    assert rows(quality.join_reconciliation(base, steps, spread=forced)) == sorted(expected)
