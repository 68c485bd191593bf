"""Dimensions, facts and the transaction matrix."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketide.functions.scalars import joined_labels
from marketide.operators.encode import packed_flags
from marketide.operators.revenue import (
    attach_promotions,
    gross_profit,
    order_totals,
    with_net_revenue,
    with_order_total,
)
from marketide.operators.skew import DEFAULT, Spread, attach_to_lines, join_spread, meets_broadcast, placed

PRODUCT_COLUMNS = (
    "product_id", "product_name", "category", "segment", "size", "color", "price", "cogs",
)
CUSTOMER_COLUMNS = (
    "zip", "customer_id", "city", "region", "district",
    "signup_date", "gender", "age_group", "acquisition_channel",
)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*PRODUCT_COLUMNS)


def dim_customer(customers: DataFrame, geography: DataFrame, spread: Spread = DEFAULT) -> DataFrame:
    """Customers with their region; the customer's own city is kept."""
    places = geography.drop("city")
    return join_spread(customers, places, ["zip"], "left", spread=spread).select(*CUSTOMER_COLUMNS)


def returns_by_line(returns: DataFrame, with_date: bool = False, spread: Spread = DEFAULT) -> DataFrame:
    """Returns per (order, product): total quantity, distinct reasons, latest date."""
    columns = [F.coalesce(F.sum("return_quantity"), F.lit(0)).alias("return_quantity")]
    if with_date:
        columns.append(F.max("return_date").alias("return_date"))
    columns.append(joined_labels("return_reason").alias("return_reason"))
    return _by_line(returns, spread).agg(*columns)


def reviews_by_line(reviews: DataFrame, spread: Spread = DEFAULT) -> DataFrame:
    """Reviews per (order, product): mean rating rounded half to even, latest date."""
    return _by_line(reviews, spread).agg(
        F.bround(F.avg("rating"), 0).cast("int").alias("rating"),
        F.max("review_date").alias("review_date"),
    )


def _by_line(df: DataFrame, spread: Spread):
    """Placed by order, where the lines meet them."""
    keyed = df.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    return placed(keyed, ["order_id"], spread).groupBy("order_id", "product_id")


def order_grain(lines: DataFrame, *tables: DataFrame, totals: bool = False) -> DataFrame:
    """Everything known per order, for the orders that have lines.

    Joining the order-grain tables with each other first leaves a single join for
    the far larger lines.
    """
    base = order_totals(lines) if totals else None
    if base is None:
        base = lines.where(F.col("order_id").isNotNull()).select("order_id").distinct()
    for table in tables:
        base = base.join(table, "order_id", "left")
    return base


def _with_order_grain(lines: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``lines`` with their order's total and the columns of the order-grain tables; no order may be frequent.

    The lines must be those of the order and no others, as none is counted twice. All of it
    needs one placement by order.
    """
    out = with_order_total(lines)
    for table in tables:
        out = out.join(table, "order_id", "left")
    return out


def fact_sales(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    products: DataFrame,
    promotions: DataFrame,
    spread: Spread = DEFAULT,
) -> DataFrame:
    """Sales at order-line grain with net revenue and gross profit.

    Orders, payments and shipments have one row per order and products and
    promotions one per id; the line count is that of ``order_items``.
    """
    by_order = [
        orders.select("order_id", "order_date", "customer_id", "order_status", "payment_method"),
        payments.select("order_id", "installments"),
        shipments.select("order_id", "shipping_fee", "ship_date", "delivery_date").withColumn(
            "delivery_days", F.datediff("delivery_date", "ship_date")
        ),
    ]
    # Lines are joined by promotion and product while they are narrow, but what is broadcast moves
    # no line: it comes last, so that the lines do not take its columns along.
    costs = products.select("product_id", "cogs")
    lines, late_terms, late_costs = order_items, meets_broadcast(promotions, spread), meets_broadcast(costs, spread)
    if not late_terms:
        lines = attach_promotions(lines, promotions, probe=order_items, spread=spread)
    if not late_costs:
        lines = join_spread(lines, costs, ["product_id"], "left", order_items, spread)
    lines = attach_to_lines(
        lines, order_grain(order_items, *by_order, totals=True), [returns_by_line(returns, spread=spread)], spread,
        order_items, partial(_with_order_grain, tables=by_order) if late_terms and late_costs else None,
    )
    if late_terms:
        lines = attach_promotions(lines, promotions, probe=order_items, spread=spread)
    if late_costs:
        lines = join_spread(lines, costs, ["product_id"], "left", order_items, spread)
    priced = with_net_revenue(lines).withColumn("gross_profit", gross_profit())
    return priced.select(
        *order_items.columns,
        "order_date", "customer_id", "order_status", "payment_method", "installments",
        "shipping_fee", "ship_date", "delivery_date", "delivery_days",
        "return_quantity", "return_reason", "actual_revenue", "gross_profit",
    )


def revenue_lines(
    order_items: DataFrame, orders: DataFrame, promotions: DataFrame, spread: Spread = DEFAULT
) -> DataFrame:
    """order_id, customer_id and net revenue of every line, as the sales fact has them, and nothing else."""
    per_order = order_grain(order_items, orders.select("order_id", "customer_id"), totals=True)
    lines = attach_promotions(order_items, promotions, probe=order_items, spread=spread)
    lines = attach_to_lines(lines, per_order, [], spread, order_items)
    return with_net_revenue(lines).select("order_id", "customer_id", "actual_revenue")


def transaction_matrix(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    totals: bool = False,
    spread: Spread = DEFAULT,
    wider: DataFrame | None = None,
) -> DataFrame:
    """Order lines with order, payment, shipment, return and review columns.

    No return becomes quantity 0, no review becomes rating -1. With ``totals`` the
    undiscounted order value is kept as ``order_base_total``. ``wider`` are the lines with
    what was joined to them while they were narrow; totals and keys are those of ``order_items``.
    """
    per_order = order_grain(
        order_items,
        orders,
        payments.select("order_id", "installments"),
        shipments.select("order_id", "ship_date", "delivery_date", "shipping_fee"),
        totals=totals,
    )
    by_line = [returns_by_line(returns, True, spread), reviews_by_line(reviews, spread)]
    lines = attach_to_lines(order_items if wider is None else wider, per_order, by_line, spread, order_items)
    quantity = F.coalesce(F.col("return_quantity"), F.lit(0)).cast("int")
    return lines.withColumns({
        "return_quantity": quantity,
        "is_returned": (quantity > 0).cast("int"),
        "rating": F.coalesce(F.col("rating"), F.lit(-1)).cast("int"),
    })


def net_revenue_lines(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    promotions: DataFrame,
    spread: Spread = DEFAULT,
    products: DataFrame | None = None,
) -> DataFrame:
    """The transaction matrix with base revenue, discount and net revenue per line.

    Lines meet promotions, and ``products`` if given, before the columns of their order make
    them wide; the columns of the products come last.
    """
    kept = [c for c in promotions.columns if c != "promo_id"]
    wider = attach_promotions(order_items, promotions, tuple(kept), order_items, spread)
    if products is not None:
        wider = join_spread(wider, products, ["product_id"], "left", order_items, spread)
    late = [*kept, *[c for c in wider.columns if c not in {*order_items.columns, *kept}]]
    matrix = transaction_matrix(
        order_items, orders, payments, shipments, returns, reviews, True, spread, wider
    )
    money = ["base_revenue", "final_discount", "actual_revenue"]
    order = [*[c for c in matrix.columns if c not in late], *kept, *money, *late[len(kept):]]
    priced = with_net_revenue(matrix, clean_type=False).select(*[F.col(f"`{c}`") for c in order])
    return priced.drop("order_base_total", "promo_type", "min_order_value", "discount_value")


def with_master_data(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    promotions: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    spread: Spread = DEFAULT,
) -> DataFrame:
    """``net_revenue_lines`` with all product and customer columns, plus cost and gross profit.

    Products are joined to the narrow lines and customers to the orders, so that no join moves
    the wide lines; 0/1 columns travel as bits of a whole number.
    """
    own = [[c for c in df.columns if c != key] for df, key in ((products, "product_id"), (customers, "customer_id"))]
    slim_products, products_back = packed_flags(products, "product_flags")
    slim_customers, customers_back = packed_flags(customers, "customer_flags")
    known = join_spread(orders, slim_customers, ["customer_id"], "left", orders, spread)
    lines = net_revenue_lines(
        order_items, known, payments, shipments, returns, reviews, promotions, spread, slim_products
    )
    joined = {*slim_products.columns, *slim_customers.columns} - {"product_id", "customer_id"}
    wide = lines.select(
        *[F.col(f"`{c}`") for c in lines.columns if c not in joined],
        *[back.get(c, F.col(f"`{c}`")).alias(c) for names, back in zip(own, (products_back, customers_back)) for c in names],
    )
    return wide.withColumn("total_cogs", F.col("cogs") * F.col("quantity")).withColumn(
        "gross_profit", F.col("actual_revenue") - F.col("total_cogs")
    )


def star_schema(tables: dict[str, DataFrame], spread: Spread = DEFAULT) -> dict[str, DataFrame]:
    """The six published tables by name."""
    return {
        "dim_product": dim_product(tables["products"]),
        "dim_customer": dim_customer(tables["customers"], tables["geography"], spread),
        "dim_promotion": tables["promotions"],
        "fact_sales": fact_sales(
            *(tables[n] for n in (
                "order_items", "orders", "payments", "shipments", "returns", "products", "promotions"
            )),
            spread=spread,
        ),
        "fact_inventory": tables["inventory"],
        "fact_webtraffic": tables["web_traffic"],
    }
