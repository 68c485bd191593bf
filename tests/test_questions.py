import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import d, retail, rows
from marketide.operators import questions as q
from marketide.operators.star import dim_customer, fact_sales


@pytest.fixture(scope="module")
def tables(spark):
    return retail(spark)


def test_order_gap_equals_pandas_with_a_hot_customer(spark):
    rng = np.random.default_rng(3)
    n = 600
    customers = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 60, n))
    frame = pd.DataFrame({
        "order_id": np.arange(n), "customer_id": customers,
        "order_date": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 90, n), "D"),
    })
    ordered = frame.sort_values(["customer_id", "order_date"])
    gaps = ordered.groupby("customer_id")["order_date"].diff().dt.days
    orders = spark.createDataFrame(frame).withColumn("order_date", F.to_date("order_date"))
    got = q.order_gaps(orders)
    assert {r.gap_days: r.n for r in got.collect()} == gaps.dropna().astype(int).value_counts().to_dict()
    assert rows(q.q1_order_gap(orders)) == [(gaps.median(),)]


def test_order_gap_ignores_missing_keys_and_days(spark):
    orders = spark.createDataFrame(
        [(None, d("2020-01-01")), (None, d("2020-01-09")), (1, None), (1, d("2020-01-01")), (1, d("2020-01-04"))],
        "customer_id long, order_date date",
    )
    assert rows(q.q1_order_gap(orders)) == [(3.0,)]


def test_top_label_ties_go_to_the_lowest_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("z", None)], "k string, v int")
    assert rows(q.top_label(df, "k", "v")) == [("a", 2)]
    assert rows(q.top_label(df, "k", "v", ascending=True)) == [("c", 1)]


def test_segment_margin(tables):
    got = dict(rows(q.q2_segment_margin(tables["products"])))
    assert got["Basic"] == pytest.approx((0.4 + 0.6) / 2)
    assert got["Premium"] == pytest.approx(0.5)


def test_return_reasons(tables):
    got = rows(q.q3_return_reasons(tables["returns"], tables["products"], "Streetwear"))
    assert got == [("damaged", 2), ("lost", 1), ("wrong size", 1)]
    assert rows(q.q3_return_reasons(tables["returns"], tables["products"], "Outdoor")) == []


def test_shares_and_means(spark, tables):
    assert rows(q.q5_promoted_share(tables["order_items"])) == [(80.0,)]
    assert rows(q.q8_cancelled_payments(tables["orders"])) == [("card", 2), ("cod", 1)]
    assert rows(q.q10_installments(tables["payments"])) == [(1, 500.0), (3, 500.0), (6, 240.0)]
    traffic = spark.createDataFrame([("a", 0.2), ("a", 0.4), ("b", 0.1), (None, 0.0)], "traffic_source string, bounce_rate double")
    assert [r[0] for r in rows(q.q4_bounce_rate(traffic))] == ["a", "b"]


def test_orders_per_age_group(tables):
    people = dim_customer(tables["customers"], tables["geography"])
    assert rows(q.q6_orders_per_age_group(tables["orders"], people)) == [("18-24", 2.0), ("55+", 2.0)]


def test_region_revenue(tables):
    sales = fact_sales(*[tables[n] for n in (
        "order_items", "orders", "payments", "shipments", "returns", "products", "promotions")])
    people = dim_customer(tables["customers"], tables["geography"])
    got = dict(rows(q.q7_region_revenue(sales, people)))
    assert got == {"Central": pytest.approx(180 + 300 + 499), "North": pytest.approx(450.9)}


def test_return_rate_repeats_lines_like_a_join(tables):
    joined = (
        tables["order_items"].join(tables["products"].select("product_id", "size"), "product_id")
        .join(tables["returns"].select("order_id", "product_id", "return_quantity"),
              ["order_id", "product_id"], "left")
        .where(F.col("size").isNotNull()).groupBy("size")
        .agg(F.sum("quantity").alias("s"), F.sum(F.coalesce("return_quantity", F.lit(0))).alias("r"))
    )
    expected = {r["size"]: (r["s"], r["r"]) for r in joined.collect()}
    got = q.q9_return_rate(tables["order_items"], tables["products"], tables["returns"])
    assert {r["size"]: (r.total_sold, r.total_returned) for r in got.collect()} == expected
    once = q.q9_return_rate(
        tables["order_items"], tables["products"], tables["returns"], repeat_lines=False
    )
    assert {r["size"]: r.total_sold for r in once.collect()}["M"] == 2 + 1 + 1 + 1
