"""The retail tables, taken from the star-schema test tables.

``load_roles`` maps customers, orders, lines, parts and events onto the tables the
operators expect. Everything is a projection or an aggregate of the given tables;
only promotions, holidays and the price index are small fixed lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketide.sources.readers import nan_to_null

# Test promotions, one per discount step of the lines but the seventh, so that lines with P7
# match nothing. They cover: no minimum and minimums below, around and above usual orders,
# small shares and a fixed amount above most line values, categories, stacking.
PROMOTION_ROWS = """
    ('P1',  'first basket',   'percentage', 7.5,     DATE'1995-01-09', DATE'1995-11-24', CAST(NULL AS STRING), 'mobile_app', 1, 0),
    ('P2',  'parcel voucher', 'fixed',      240.0,   DATE'1995-12-04', DATE'1996-05-10', CAST(NULL AS STRING), 'voucher',    0, 0),
    ('P3',  'bulk buyer',     'percentage', 33.0,    DATE'1996-05-13', DATE'1996-09-27', CAST(NULL AS STRING), 'call_centre', 1, 90000),
    ('P4',  'thousand off',   'fixed',      1000.0,  DATE'1996-10-07', DATE'1997-02-14', CAST(NULL AS STRING), 'mobile_app', 0, 60000),
    ('P5',  'jubilee',        'percentage', 5.0,     DATE'1997-06-16', DATE'1997-06-29', 'STANDARD',           'storefront', 0, 120000),
    ('P6',  'shelf clearing', 'fixed',      65000.0, DATE'1997-12-08', DATE'1998-03-06', 'SMALL',              'storefront', 1, 0),
    ('P8',  'giant order',    'percentage', 12.5,    DATE'1998-08-10', DATE'1999-08-13', CAST(NULL AS STRING), 'call_centre', 0, 260000),
    ('P9',  'points redeemed','fixed',      15.0,    DATE'1999-10-18', DATE'2000-04-21', 'MEDIUM',             'voucher',    1, 45000),
    ('P10', 'end of range',   'percentage', 45.0,    DATE'2000-07-03', DATE'2001-05-25', CAST(NULL AS STRING), 'storefront', 0, 0)
"""

# Test holidays: new year, two spring days and one autumn day.
HOLIDAY_MONTH_DAYS = ("01-01", "04-30", "05-01", "09-02")
HOLIDAY_YEARS = range(1995, 2002)

# Test price index: monthly from 1997-01, with 1999-06 missing and 2001 missing.
CPI_START = "1997-01-01"
CPI_MONTHS = 48
CPI_GAP = "1999-06-01"

PROMOTION_COLUMNS = (
    "promo_id, promo_name, promo_type, discount_value, start_date, end_date, "
    "applicable_category, promo_channel, stackable_flag, min_order_value"
)

AGE_GROUPS = "'Unknown', '18-24', '25-34', '35-44', '45-54', '55+'"


def promotions(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT {PROMOTION_COLUMNS} FROM VALUES {PROMOTION_ROWS} AS t({PROMOTION_COLUMNS})"
    ).withColumn("discount_value", F.col("discount_value").cast("double"))


def holidays(spark: SparkSession) -> DataFrame:
    days = ", ".join(f"(DATE'{y}-{md}')" for y in HOLIDAY_YEARS for md in HOLIDAY_MONTH_DAYS)
    return spark.sql(f"SELECT date FROM VALUES {days} AS t(date)")


def cpi(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
        SELECT add_months(DATE'{CPI_START}', CAST(id AS INT)) AS month_start,
               CAST(80 AS DOUBLE) + CAST(id AS DOUBLE) / 4 AS CPI
        FROM range({CPI_MONTHS})
        WHERE add_months(DATE'{CPI_START}', CAST(id AS INT)) <> DATE'{CPI_GAP}'
    """)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def order_items(lineitem: DataFrame) -> DataFrame:
    step = F.round(F.col("l_discount") * 100).cast("int")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("P"), step.cast("string"))).alias("promo_id"),
    )


def products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("segment"),
        F.when(size <= 10, "S").when(size <= 20, "M").when(size <= 30, "L")
        .when(size <= 40, "XL").otherwise("XXL").alias("size"),
        F.substring_index("p_name", " ", 1).alias("color"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") * (F.lit(0.5) + size / 200)).alias("cogs"),
    )


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    age = F.try_element_at(
        F.expr(f"array({AGE_GROUPS}, CAST(NULL AS STRING))"), (key % 7 + 1).cast("int")
    )
    cities = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    return customer.join(cities, "c_nationkey", "left").select(
        key.alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("zip"),
        "city",
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 1000).cast("int")).alias("signup_date"),
        F.when(key % 3 == 0, "female").when(key % 3 == 1, "male").alias("gender"),
        age.alias("age_group"),
        F.col("c_mktsegment").alias("acquisition_channel"),
    )


def geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    names = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return nation.join(names, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("string").alias("zip"),
        F.col("n_name").alias("city"),
        "region",
        F.concat(F.lit("district "), (F.col("n_nationkey") % 4).cast("string")).alias("district"),
    )


def orders(orders_table: DataFrame) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "Cancelled").when(
        F.col("o_orderstatus") == "O", "delivered"
    ).otherwise("shipped")
    return orders_table.select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def payments(orders_table: DataFrame) -> DataFrame:
    return orders_table.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("payment_value"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("installments"),
    )


def shipments(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.to_date(F.min("l_shipdate")).alias("ship_date"),
        F.to_date(F.max("l_shipdate")).alias("delivery_date"),
        (F.min("l_tax") * 100).alias("shipping_fee"),
    )


def returns(lineitem: DataFrame) -> DataFrame:
    return lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("return_quantity"),
        F.col("l_linestatus").alias("return_reason"),
        F.to_date("l_shipdate").alias("return_date"),
    )


def reviews(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.least(F.col("l_linenumber"), F.lit(5)).cast("int").alias("rating"),
        F.to_date("l_shipdate").alias("review_date"),
    )


def web_traffic(events: DataFrame) -> DataFrame:
    return events.select(
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("traffic_source"),
        F.col("value").alias("bounce_rate"),
    )


def daily_sessions(orders_table: DataFrame) -> DataFrame:
    """Traffic that spans the order history: customers who ordered, per day."""
    return orders_table.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count_distinct("o_custkey").alias("sessions")
    )


# Role table -> (builder, test tables it reads).
BUILDERS = {
    "products": (products, ("part",)),
    "customers": (customers, ("customer", "nation")),
    "geography": (geography, ("nation", "region")),
    "orders": (orders, ("orders",)),
    "order_items": (order_items, ("lineitem",)),
    "payments": (payments, ("orders",)),
    "shipments": (shipments, ("lineitem",)),
    "returns": (returns, ("lineitem",)),
    "reviews": (reviews, ("lineitem",)),
    "web_traffic": (web_traffic, ("events",)),
    "daily_sessions": (daily_sessions, ("orders",)),
    "inventory": (lambda part: part, ("part",)),
}
FIXED = {"promotions": promotions, "holidays": holidays, "cpi": cpi}


class Roles(dict):
    """The retail tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in FIXED:
            self[name] = FIXED[name](self.spark)
        else:
            build, needed = BUILDERS[name]
            self[name] = build(*(_read(self.spark, self.sf_dir, table) for table in needed))
        return self[name]


def load_roles(spark: SparkSession, sf_dir: str) -> Roles:
    return Roles(spark, sf_dir)
