"""Discounts, star schema, transaction matrix, and joins with frequent keys."""

import pytest
from pyspark.sql import functions as F

from helpers import d, retail, rows, same
from marketide.operators import revenue, series, star
from marketide.functions.scalars import exact_sum, part_sums, whole_sum
from marketide.operators.skew import Spread, frequent_keys, join_spread
from marketide.sources import roles

# Spreads whatever is above a few rows, so that small frames take the large path.
EAGER = Spread(above_bytes=0, rows_per_task=3, broadcast_small=False)

FACT = ("order_items", "orders", "payments", "shipments", "returns", "products", "promotions")
MATRIX = ("order_items", "orders", "payments", "shipments", "returns", "reviews")


def pick(tables, names):
    return [tables[n] for n in names]


@pytest.fixture(scope="module")
def tables(spark):
    return retail(spark)


def by_line(df, *columns):
    return {
        (r.order_id, r.product_id, r.unit_price): tuple(r[c] for c in columns) for r in df.collect()
    }


def test_discounts(tables):
    got = by_line(star.fact_sales(*pick(tables, FACT)), "actual_revenue", "gross_profit")
    assert got[(1, 10, 100.0)] == (180.0, 60.0)       # 10 % of 200, order total exactly the minimum
    assert got[(1, 11, 300.0)] == (300.0, 150.0)
    assert got[(2, 10, 499.0)] == (499.0, 439.0)      # below the minimum
    assert got[(3, 10, 501.0)] == (450.9, 390.9)
    assert got[(4, 11, 40.0)] == (0.0, -150.0)        # never below zero
    assert got[(4, 11, 100.0)] == (150.0, -150.0)     # once per line
    assert got[(5, 12, 70.0)] == (70.0, 50.0)         # unknown promotion
    assert got[(6, 10, 10.0)] == (None, None)         # missing quantity stays missing
    assert got[(7, 99, 10.0)] == (30.0, None)         # no cost known
    assert got[(None, 10, 20.0)] == (20.0, -40.0)     # no order, no total, no discount


def test_type_label_as_written(tables):
    """The transaction path compares the label untrimmed, so ' Percentage ' grants nothing there."""
    lines = star.net_revenue_lines(*pick(tables, (*MATRIX, "promotions")))
    got = by_line(lines, "final_discount", "actual_revenue", "base_revenue")
    assert got[(1, 10, 100.0)] == (0.0, 200.0, 200.0)
    assert got[(4, 11, 100.0)] == (50.0, 150.0, 200.0)
    assert "min_order_value" not in lines.columns and "order_base_total" not in lines.columns


def test_promotion_dates_are_checked_on_request(tables):
    lines = tables["order_items"].join(tables["orders"], "order_id", "left").join(
        revenue.order_totals(tables["order_items"]), "order_id", "left"
    )
    terms = revenue.attach_promotions(
        lines, tables["promotions"], (*revenue.PROMOTION_TERMS, "start_date", "end_date")
    )
    got = by_line(revenue.with_net_revenue(terms, valid_on="dates"), "final_discount")
    assert got[(1, 10, 100.0)] == (20.0,)   # inside the dates
    assert got[(3, 10, 501.0)] == (0.0,)    # after them
    assert got[(4, 11, 100.0)] == (0.0,)


def test_fact_sales_columns_and_rows(tables):
    fact = star.fact_sales(*pick(tables, FACT))
    assert fact.count() == tables["order_items"].count()
    got = by_line(fact, "delivery_days", "return_quantity", "return_reason", "installments")
    assert got[(1, 10, 100.0)] == (3, 2, "damaged, wrong size", 3)
    assert got[(3, 10, 501.0)] == (0, None, None, 1)
    assert got[(4, 11, 40.0)] == (None, 1, "", 6)     # only a missing reason
    assert got[(7, 99, 10.0)] == (None, None, None, None)


def test_transaction_matrix(tables):
    matrix = star.transaction_matrix(*pick(tables, MATRIX))
    assert matrix.count() == tables["order_items"].count()
    got = by_line(matrix, "return_quantity", "is_returned", "return_date", "rating", "review_date")
    assert got[(1, 10, 100.0)] == (2, 1, d("2020-01-12"), 2, d("2020-01-21"))   # 2.5 rounds to 2
    assert got[(1, 11, 300.0)] == (0, 0, None, 4, d("2020-01-20"))              # 3.5 rounds to 4
    assert got[(None, 10, 20.0)] == (0, 0, None, -1, None)


def test_dim_customer_keeps_own_city(tables):
    got = {r.customer_id: r for r in star.dim_customer(tables["customers"], tables["geography"]).collect()}
    assert (got[100].city, got[100].region) == ("Hue", "Central")
    assert (got[102].city, got[102].region) == (None, None)


def test_daily_sales_and_slices(tables):
    lines = series.priced_lines(*pick(tables, ("order_items", "orders", "returns", "products", "promotions")))
    daily = {r.date: r for r in series.daily_sales(lines).collect()}
    first = daily[d("2020-01-01")]
    assert (first.order_id, first.customer_id, first.quantity, first.is_returned) == (2, 1, 4, 1)
    assert first.actual_revenue == 200.0 + 300.0 + 499.0
    march = daily[d("2020-03-01")]
    assert (march.order_id, march.customer_id) == (2, 1)   # a missing customer is not counted
    assert march.actual_revenue == 70.0                    # the missing line adds nothing
    wide = {
        r.date: r for r in series.daily_slices(
            lines, {"category": ["Streetwear", "Outdoor"], "color": ["red"]}
        ).collect()
    }
    for day, r in wide.items():
        known = r.revenue_category_Streetwear + r.revenue_category_Outdoor
        assert same(known, daily[day].actual_revenue)
    assert wide[d("2020-03-01")].revenue_color_red == 0.0
    whole = series.daily_series(lines, {"category": ["Streetwear", "Outdoor"], "color": ["red"]})
    got = {r.date: r.asDict() for r in whole.collect()}
    assert got == {day: daily[day].asDict() | r.asDict() for day, r in wide.items()}
    per_color = series.daily_series(lines, {"category": ["Outdoor"]}, ("color",))
    one_way = series.daily_sales(lines, ("color",))
    assert rows(per_color.select(*one_way.columns)) == rows(one_way)   # a missing key stays a series
    long = rows(series.daily_slices_long(lines))
    assert (d("2020-01-01"), "color", "red", 699.0) in long
    assert all(label is not None for _, _, label, _ in long)


def hot_tables(spark, tables):
    """One order, one line of it, one product and missing promotions hold most rows."""
    base = spark.range(400).repartition(7)
    many = base.select(
        F.when(F.col("id") < 300, F.lit(1)).otherwise(F.col("id")).cast("long").alias("order_id"),
        F.when(F.col("id") < 200, F.lit(10)).otherwise(F.col("id") % 5 + 9).cast("long").alias("product_id"),
        (F.col("id") % 3 + 1).cast("int").alias("quantity"),
        (F.col("id") * 1.5).alias("unit_price"),
        F.when(F.col("id") % 3 == 0, F.lit("A")).alias("promo_id"),
    )
    return tables | {"order_items": tables["order_items"].unionByName(many)}


def test_spread_lines_give_the_same_rows(spark, tables):
    hot = hot_tables(spark, tables)
    for build, names in ((star.fact_sales, FACT), (star.transaction_matrix, MATRIX),
                         (star.net_revenue_lines, (*MATRIX, "promotions"))):
        plain = build(*pick(hot, names))
        spread = build(*pick(hot, names), spread=EAGER)
        assert spread.columns == plain.columns
        assert rows(spread) == rows(plain), build.__name__
        assert spread.count() == hot["order_items"].count()


def test_hot_order_is_dealt_over_tasks(spark, tables):
    hot = hot_tables(spark, tables)
    keys = {"o": ["order_id"], "p": ["order_id", "product_id"]}
    found = frequent_keys(hot["order_items"], keys, EAGER)
    orders = {r.o_hash: r.o_tasks for r in found["o"].collect()}
    pairs = {r.p_hash: r.p_tasks for r in found["p"].collect()}
    assert max(orders.values()) >= 300 // EAGER.rows_per_task
    assert max(pairs.values()) >= 200 // EAGER.rows_per_task
    counts = hot["order_items"].groupBy("order_id").count().where("order_id IS NOT NULL AND count > 3")
    assert len(orders) == counts.count()
    lines = star.fact_sales(*pick(hot, FACT), spread=EAGER)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan


def test_no_task_holds_the_hot_order(spark, tables):
    """Three quarters of the lines are one order; no partition after the joins holds half of it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        hot = hot_tables(spark, tables)
        matrix = star.transaction_matrix(*pick(hot, MATRIX), spread=EAGER)
        plain = star.transaction_matrix(*pick(hot, MATRIX))
        sizes = [
            max(r.n for r in df.where("order_id = 1").groupBy(F.spark_partition_id().alias("task"))
                .agg(F.count("*").alias("n")).collect())
            for df in (matrix, plain)
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes[1] == 302 and sizes[0] < 151


def test_every_frequent_key_is_found(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 40).otherwise(F.col("id") + 100).alias("k"))
    found = frequent_keys(df, {"k": ["k"]}, Spread(rows_per_task=40))["k"]
    assert found.count() == 20 and {r.k_tasks for r in found.collect()} == {2}


def test_hot_order_without_products_is_dealt_out(spark, tables):
    """The lines of a hot order that have no product do not meet in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = spark.range(400).repartition(8).select(
            F.lit(1).cast("long").alias("order_id"), F.lit(None).cast("long").alias("product_id"),
            F.lit(1).alias("quantity"), F.lit(2.0).alias("unit_price"), F.lit(None).cast("string").alias("promo_id"),
        )
        matrix = star.transaction_matrix(*pick(tables | {"order_items": many}, MATRIX), spread=Spread(
            above_bytes=0, rows_per_task=20, broadcast_small=False))
        sizes = [r.n for r in matrix.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 400 and max(sizes) < 300


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_both_sides_see_one_list(spark, tables, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        hot = hot_tables(spark, tables)
        assert rows(star.fact_sales(*pick(hot, FACT), spread=EAGER)) == rows(star.fact_sales(*pick(hot, FACT)))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_small_amounts_are_not_lost(spark):
    df = spark.range(1_000_000).select(F.lit(4e-7).alias("amount"), (F.col("id") % 3).alias("k"))
    assert df.agg(exact_sum("amount").alias("s")).first().s == 0.4
    parts = df.groupBy("k").agg(*part_sums("amount", "a"))
    assert parts.agg(whole_sum("a").alias("s")).first().s == 0.4
    negative = spark.createDataFrame([(-0.1,), (0.3,), (None,)], "amount double")
    assert negative.agg(exact_sum("amount").alias("s")).first().s == 0.2


def test_lines_are_shuffled_once_for_order_and_line_joins(spark, tables):
    """Joins on (order, salt) and on (order, product, salt) share one placement."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        matrix = star.transaction_matrix(*pick(hot_tables(spark, tables), MATRIX), spread=EAGER)
        plan = matrix._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(order_id#" in plan
    placed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "salt" in line]
    assert len(placed) == 4                                  # lines, orders, returns, reviews
    assert all("product_id" not in line for line in placed)


def test_a_small_right_side_is_broadcast_not_salted(spark, tables):
    """However large the lines are, a few promotions never make them shuffle."""
    large = Spread(above_bytes=0, rows_per_task=3)
    joined = revenue.attach_promotions(tables["order_items"], roles.promotions(spark), spread=large)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hash" not in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_spread_equals_join(spark, how):
    left = spark.range(200).repartition(5).select(
        F.when(F.col("id") < 120, F.lit(7)).when(F.col("id") < 150, F.lit(None)).otherwise(F.col("id"))
        .cast("int").alias("k"),
        "id",
    )
    right = spark.createDataFrame(
        [(7, "a"), (7, "b"), (160, "c"), (None, "n"), (999, "z")], "k long, v string"
    )
    expected = left.join(right.withColumn("k", F.col("k").cast("int")), "k", how)
    assert rows(join_spread(left, right, ["k"], how, spread=EAGER)) == rows(expected)
    with pytest.raises(ValueError):
        join_spread(left, right, ["k"], "full")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_join_spread_without_rows_or_keys(spark, adaptive):
    """No left rows, or only missing keys: nothing to count, and many empty partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        right = spark.createDataFrame([(7, "a")], "k long, v string")
        missing = spark.range(6).select(F.lit(None).cast("long").alias("k"), "id")
        assert rows(join_spread(missing, right, ["k"], "left", spread=EAGER)) == [
            (None, i, None) for i in range(6)
        ]
        assert rows(join_spread(missing, right, ["k"], "inner", spread=EAGER)) == []
        empty = spark.range(6).where("id > 9").select(F.col("id").alias("k"), "id")
        assert rows(join_spread(empty, right, ["k"], "left", spread=EAGER)) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_deflate_fills_both_ways(spark):
    days = spark.createDataFrame(
        [(d("2020-01-05"), 80.0), (d("2020-02-05"), 90.0), (d("2020-03-05"), 120.0), (d("2020-04-05"), 60.0)],
        "date date, actual_revenue double",
    )
    cpi = spark.createDataFrame(
        [(d("2020-02-01"), 90.0), (d("2020-04-01"), 120.0)], "month_start date, CPI double"
    )
    got = rows(revenue.deflate(days, cpi).select("date", "CPI", "actual_revenue"))
    assert [r[1] for r in got] == [90.0, 90.0, 90.0, 120.0]
    assert [round(r[2], 6) for r in got] == [round(80 / 0.9, 6), 100.0, round(120 / 0.9, 6), 50.0]
    assert rows(revenue.deflate(days, None).select("inflation_factor"))[0] == (1.0,)
    later = spark.createDataFrame([(d("2020-02-29"),), (d("2024-01-01"),)], "date date")
    assert [r[1] for r in rows(revenue.index_of_day(later, cpi))] == [0.9, 1.2]
    assert [r[1] for r in rows(revenue.index_of_day(later, None))] == [1.0, 1.0]
