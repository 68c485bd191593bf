"""Column types of every table the library reads."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "string": StringType(),
}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


PRODUCTS = _schema(
    product_id="long", product_name="string", category="string", segment="string",
    size="string", color="string", price="double", cogs="double",
)
CUSTOMERS = _schema(
    customer_id="long", zip="string", city="string", signup_date="date",
    gender="string", age_group="string", acquisition_channel="string",
)
GEOGRAPHY = _schema(zip="string", city="string", region="string", district="string")
ORDERS = _schema(
    order_id="long", order_date="date", customer_id="long",
    order_status="string", payment_method="string",
)
ORDER_ITEMS = _schema(
    order_id="long", product_id="long", quantity="int", unit_price="double", promo_id="string",
)
PAYMENTS = _schema(
    order_id="long", payment_method="string", payment_value="double", installments="int",
)
SHIPMENTS = _schema(
    order_id="long", ship_date="date", delivery_date="date", shipping_fee="double",
)
RETURNS = _schema(
    order_id="long", product_id="long", return_quantity="int",
    return_reason="string", return_date="date",
)
REVIEWS = _schema(order_id="long", product_id="long", rating="int", review_date="date")
PROMOTIONS = _schema(
    promo_id="string", promo_name="string", promo_type="string", discount_value="double",
    start_date="date", end_date="date", applicable_category="string",
    promo_channel="string", stackable_flag="int", min_order_value="int",
)
SALES = _schema(Date="date", Revenue="double", COGS="double")
WEB_TRAFFIC = _schema(
    date="date", traffic_source="string", sessions="long", bounce_rate="double",
)
CPI = StructType([StructField("CPI", DoubleType()), StructField("Thời Gian", DateType())])

# Inventory is passed through untouched, so it has no fixed columns.
TABLES: dict[str, StructType | None] = {
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "shipments": SHIPMENTS,
    "returns": RETURNS,
    "reviews": REVIEWS,
    "geography": GEOGRAPHY,
    "promotions": PROMOTIONS,
    "sales": SALES,
    "inventory": None,
    "web_traffic": WEB_TRAFFIC,
}
