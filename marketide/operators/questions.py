"""Ten business questions.

Each reduces its large table per join key before joining, so that a customer,
product or order with very many rows is one row per input split by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.scalars import part_sums, whole_sum


def top_label(df: DataFrame, key: str, value: str, ascending: bool = False) -> DataFrame:
    """The row with the largest (or smallest) value; ties go to the lowest key."""
    order = F.asc(value) if ascending else F.desc(value)
    return df.where(F.col(value).isNotNull()).orderBy(order, F.asc(key)).limit(1)


def order_gaps(
    orders: DataFrame, customer: str = "customer_id", day: str = "order_date"
) -> DataFrame:
    """(gap_days, n): how often each gap between consecutive orders of a customer occurs.

    Orders of one day are merged first. A customer then has at most one row per
    calendar day, however many orders there are, and the merged ones are gaps of 0.
    """
    days = (
        orders.where(F.col(customer).isNotNull() & F.col(day).isNotNull())
        .groupBy(customer, day).agg(F.count("*").alias("n_orders"))
    )
    w = Window.partitionBy(customer).orderBy(day)
    gaps = days.withColumn("gap", F.datediff(F.col(day), F.lag(day).over(w)))
    parts = F.array(
        F.struct(F.col("gap").alias("gap_days"), F.lit(1).cast("long").alias("n")),
        F.struct(F.lit(0).alias("gap_days"), (F.col("n_orders") - 1).alias("n")),
    )
    return (
        gaps.select(F.inline(parts))
        .where(F.col("gap_days").isNotNull() & (F.col("n") > 0))
        .groupBy("gap_days").agg(F.sum("n").alias("n"))
    )


def q1_order_gap(orders: DataFrame) -> DataFrame:
    """Median days between consecutive orders of a customer."""
    return order_gaps(orders).agg(
        F.percentile("gap_days", 0.5, F.col("n")).alias("median_gap_days")
    )


def q2_segment_margin(products: DataFrame) -> DataFrame:
    """Mean of (price - cogs) / price per segment."""
    margin = F.try_divide(F.col("price") - F.col("cogs"), F.col("price"))
    return (
        products.where(F.col("segment").isNotNull())
        .groupBy("segment").agg(F.avg(margin).alias("gross_margin"))
    )


def q3_return_reasons(returns: DataFrame, products: DataFrame, category: str) -> DataFrame:
    """Number of returns per reason in one category."""
    counts = (
        returns.where(F.col("return_reason").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("product_id", "return_reason").agg(F.count("*").alias("n"))
    )
    chosen = products.where(F.col("category") == category).select("product_id")
    return (
        counts.join(chosen, "product_id")
        .groupBy("return_reason").agg(F.sum("n").alias("n_returns"))
    )


def q4_bounce_rate(web_traffic: DataFrame) -> DataFrame:
    return (
        web_traffic.where(F.col("traffic_source").isNotNull())
        .groupBy("traffic_source").agg(F.avg("bounce_rate").alias("bounce_rate"))
    )


def q5_promoted_share(order_items: DataFrame) -> DataFrame:
    """Percentage of order lines that name a promotion."""
    return order_items.agg(
        (F.avg(F.col("promo_id").isNotNull().cast("double")) * 100).alias("promoted_pct")
    )


def q6_orders_per_age_group(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Mean number of orders per customer, by age group.

    Both sides are counted per customer before they meet, so neither can be skewed.
    """
    per_customer = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id").agg(F.count("*").alias("n_orders"))
    )
    groups = (
        dim_customer.where(F.col("age_group").isNotNull() & F.col("customer_id").isNotNull())
        .groupBy("customer_id", "age_group").agg(F.count("*").alias("n_rows"))
    )
    return (
        per_customer.join(groups, "customer_id")
        .groupBy("age_group")
        .agg(F.avg(F.col("n_orders") * F.col("n_rows")).alias("mean_orders"))
    )


def q7_region_revenue(sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Net revenue per region: revenue per customer first, then the region."""
    per_customer = (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(*part_sums("actual_revenue", "revenue"))
    )
    regions = dim_customer.where(F.col("region").isNotNull()).select("customer_id", "region")
    return (
        per_customer.join(regions, "customer_id")
        .groupBy("region")
        .agg(whole_sum("revenue").alias("actual_revenue"))
    )


def q8_cancelled_payments(orders: DataFrame, status: str = "cancelled") -> DataFrame:
    return (
        orders.where((F.lower("order_status") == status) & F.col("payment_method").isNotNull())
        .groupBy("payment_method").agg(F.count("*").alias("n_orders"))
    )


def q9_return_rate(
    order_items: DataFrame,
    products: DataFrame,
    returns: DataFrame,
    repeat_lines: bool = True,
) -> DataFrame:
    """Returned over sold quantity per size.

    By default a line with several returns counts its quantity once per return, as a
    join with the single returns does. ``repeat_lines=False`` counts it once. Both are
    computed from sums per (order, product), without the fan-out.
    """
    pair = ["order_id", "product_id"]
    known = F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
    sold = order_items.groupBy(*pair).agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("n_lines")
    )
    returned = returns.where(known).groupBy(*pair).agg(
        F.sum("return_quantity").alias("return_quantity"), F.count("*").alias("n_returns")
    )
    joined = sold.join(returned, pair, "left")
    if repeat_lines:
        sold_quantity = F.col("quantity") * F.coalesce("n_returns", F.lit(1))
        returned_quantity = F.col("return_quantity") * F.col("n_lines")
    else:
        sold_quantity, returned_quantity = F.col("quantity"), F.col("return_quantity")
    per_product = joined.groupBy("product_id").agg(
        F.sum(sold_quantity).alias("total_sold"),
        F.coalesce(F.sum(returned_quantity), F.lit(0)).alias("total_returned"),
    )
    sizes = products.where(F.col("size").isNotNull()).select("product_id", "size")
    return (
        per_product.join(sizes, "product_id")
        .groupBy("size")
        .agg(F.sum("total_sold").alias("total_sold"), F.sum("total_returned").alias("total_returned"))
        .withColumn("return_rate", F.try_divide(F.col("total_returned"), F.col("total_sold")))
    )


def q10_installments(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("installments").isNotNull())
        .groupBy("installments").agg(F.avg("payment_value").alias("payment_value"))
    )
