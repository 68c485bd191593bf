"""What is shuffled by the queries over order lines does not grow faster than these."""

import pytest
from pyspark.sql import functions as F

from helpers import retail, rows
from marketide.operators import encode, quality, series, skew, star
from marketide.operators.skew import Spread

FORCED = Spread(above_bytes=0, rows_per_task=1000, broadcast_small=False)
SALES = ("order_items", "orders", "payments", "shipments", "returns", "products", "promotions")
NET = ("order_items", "orders", "payments", "shipments", "returns", "reviews", "promotions")
DAILY = ("order_items", "orders", "returns", "products", "promotions")


@pytest.fixture(scope="module")
def tables(spark):
    return retail(spark)


def placed(df):
    """The column names of everything that is placed by an explicit shuffle."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "RepartitionByExpression":
            output = node.output()
            found.append({output.apply(i).name() for i in range(output.size())})
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_flags_travel_as_bits(spark):
    df = spark.createDataFrame([(i, f"l{i % 70}" if i % 9 else None, i % 3) for i in range(140)], "id int, k string, n int")
    flags = encode.one_hot(df, ["k"])
    slim, back = encode.packed_flags(flags, "bits")
    assert slim.columns == ["id", "n", "bits_0", "bits_1"] and len(back) == 70
    left = spark.createDataFrame([(i,) for i in range(150)], "id int")
    restored = left.join(slim, "id", "left").select("id", *[back.get(c, F.col(c)).alias(c) for c in flags.columns if c != "id"])
    expected = left.join(flags, "id", "left")
    assert restored.dtypes == expected.dtypes and rows(restored) == rows(expected)
    assert encode.packed_flags(df, "bits")[0].columns == df.columns


def test_wide_lines_are_not_placed_by_product_or_customer(tables):
    products, customers = encode.encode_products(tables["products"]), encode.encode_customers(tables["customers"])
    wide = star.with_master_data(*[tables[n] for n in NET], products, customers, FORCED)
    net = star.net_revenue_lines(*[tables[n] for n in NET])
    joined = net.join(products, "product_id", "left").join(customers, "customer_id", "left")
    plain = joined.withColumn("total_cogs", F.col("cogs") * F.col("quantity")).withColumn(
        "gross_profit", F.col("actual_revenue") - F.col("total_cogs")
    )
    order = [*net.columns, *[c for c in products.columns if c != "product_id"], *[c for c in customers.columns if c != "customer_id"],
             "total_cogs", "gross_profit"]
    assert wide.columns == order and rows(wide) == rows(plain.select(order))
    for columns in placed(wide):
        assert not any(c.startswith(("category_", "gender_")) for c in columns)
        assert not ("promo_id" in columns and "customer_id" in columns)


@pytest.mark.parametrize("build, names", [(star.fact_sales, SALES), (series.priced_lines, DAILY)])
def test_lines_are_narrow_where_promotion_and_product_place_them(tables, build, names):
    lines = build(*[tables[n] for n in names], spread=FORCED)
    shuffled = [c for c in placed(lines) if {"unit_price", "promo_id"} <= c]
    assert shuffled and not any(c & {"customer_id", "order_date", "order_base_total"} for c in shuffled)
    assert rows(lines) == rows(build(*[tables[n] for n in names]))


def test_lines_take_the_region_of_their_order(spark, tables):
    regions = spark.createDataFrame([(100, "North"), (101, "South"), (101, "South again")], "customer_id long, region string")
    orders = tables["orders"].join(regions, "customer_id", "left")
    given = [tables[n] for n in DAILY[2:]]
    lines = series.priced_lines(tables["order_items"], orders, *given, keys=("region",))
    after = series.priced_lines(tables["order_items"], tables["orders"], *given).join(regions, "customer_id", "left")
    assert rows(lines.select(sorted(lines.columns))) == rows(after.select(sorted(lines.columns)))


def test_frequent_keys_share_slots_with_others(spark, monkeypatch):
    df = spark.createDataFrame([(1,)] * 30 + [(i,) for i in range(2, 60)] + [(None,)] * 40, "k int")
    expected = [(h.h, 3) for h in spark.range(1).select(F.xxhash64(F.lit(1)).alias("h")).collect()]
    for slots in (1, 4, 1 << 20):
        monkeypatch.setattr(skew, "SLOTS", slots)
        assert rows(skew.frequent_keys(df, {"k": ["k"]}, Spread(rows_per_task=10))["k"]) == expected


def test_missing_orders_are_dealt_out_and_even_ones_are_not(spark):
    lines = spark.createDataFrame([(None if i % 2 else i, i % 3) for i in range(60)], "order_id int, product_id int")
    by_order = spark.createDataFrame([(i, f"o{i}") for i in range(0, 60, 4)] + [(None, "never")], "order_id int, label string")
    expected = rows(lines.join(by_order, "order_id", "left").select("order_id", "product_id", "label"))
    for each, salted in ((10, True), (1000, False)):
        got = skew.attach_to_lines(lines, by_order, [], Spread(0, each, False))
        assert rows(got) == expected and bool(placed(got)) == salted


def test_only_rows_that_may_have_copies_are_placed(spark):
    table = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"))
    copies = table.union(table.where("id < 7")).union(table.where("id = 1900").crossJoin(spark.range(50).select()))
    spread = Spread(0, 20, False)
    got = quality.duplicate_profile({"t": copies, "u": table}, spread)
    assert rows(got) == [("t", 2057, 57), ("u", 2000, 0)]
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_order_totals_need_no_shuffle_of_their_own(spark, tables, tmp_path):
    given = [tables[n] for n in SALES]
    # Lines that share an order, lines without one, and one whose order nobody knows.
    more = spark.createDataFrame(
        [(1, 10, 3, 7.25, "A"), (None, 10, 1, 5.0, "A"), (None, 11, 1, 9.0, None), (77, 10, 2, 900.0, "A")], given[0].schema
    )
    given[0] = given[0].union(more)
    # Repeated keys on the other side repeat lines and leave the totals alone.
    given[1] = given[1].union(given[1].limit(1))
    given[6] = given[6].union(given[6].limit(1))
    plain = rows(star.fact_sales(*given, spread=FORCED))
    for i in (5, 6):
        given[i].write.parquet(f"{tmp_path}/{i}")
        given[i] = spark.read.parquet(f"{tmp_path}/{i}")
    lines = star.fact_sales(*given, spread=Spread(0, 1000, True))
    assert rows(lines) == plain
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    # Promotions, which are broadcast, are met after the totals.
    assert "Window" in plan and plan.index("promo_type") < plan.index("Window")
