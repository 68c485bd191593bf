"""Small frames and comparisons for the tests."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df) -> list[tuple]:
    """The rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def assert_close(actual, expected):
    """Equal length, NULL where NaN is expected, else close."""
    actual, expected = list(actual), list(expected)
    assert len(actual) == len(expected)
    for i, (a, e) in enumerate(zip(actual, expected)):
        missing = e is None or (isinstance(e, (float, np.floating)) and np.isnan(e))
        if missing:
            assert a is None or np.isnan(a), f"row {i}: {a} is not missing"
        else:
            assert a is not None and math.isclose(a, e, rel_tol=1e-9, abs_tol=1e-7), f"row {i}: {a} != {e}"


def random_series(n: int, seed: int = 1, missing: float = 0.0, skip: float = 0.0) -> pd.DataFrame:
    """n days of positive values; some values missing, some days absent."""
    rng = np.random.default_rng(seed)
    days = pd.date_range("2015-01-01", periods=n).date
    out = pd.DataFrame({"date": days, "v": rng.gamma(2.0, 50000.0, n)})
    out.loc[rng.random(n) < missing, "v"] = np.nan
    return out[rng.random(n) >= skip].reset_index(drop=True)


def retail(spark):
    """Hand-made retail tables with the awkward cases in them."""
    order_items = spark.createDataFrame(
        [
            (1, 10, 2, 100.0, "A"),    # percentage, order total 500 meets the minimum 500
            (1, 11, 1, 300.0, None),   # no promotion
            (2, 10, 1, 499.0, "A"),    # just below the minimum
            (3, 10, 1, 501.0, "A"),    # just above
            (4, 11, 1, 40.0, "F"),     # fixed 50 > line value 40: capped
            (4, 11, 2, 100.0, "F"),    # same promotion again: 50 off this line too
            (5, 12, 1, 70.0, "X"),     # unknown promotion
            (6, 10, None, 10.0, "A"),  # missing quantity
            (7, 99, 3, 10.0, None),    # unknown product, unknown order
            (None, 10, 1, 20.0, "F"),  # no order
        ],
        "order_id long, product_id long, quantity int, unit_price double, promo_id string",
    )
    orders = spark.createDataFrame(
        [
            (1, d("2020-01-01"), 100, "Cancelled", "card"),
            (2, d("2020-01-01"), 100, "delivered", "cod"),
            (3, d("2020-01-03"), 101, "CANCELLED", "cod"),
            (4, d("2020-02-29"), 102, "cancelled", "card"),
            (5, d("2020-03-01"), None, "shipped", None),
            (6, d("2020-03-01"), 101, "shipped", "card"),
        ],
        "order_id long, order_date date, customer_id long, order_status string, payment_method string",
    )
    payments = spark.createDataFrame(
        [(1, "card", 500.0, 3), (2, "cod", 499.0, 1), (3, "cod", 501.0, 1), (4, "card", 240.0, 6)],
        "order_id long, payment_method string, payment_value double, installments int",
    )
    shipments = spark.createDataFrame(
        [(1, d("2020-01-02"), d("2020-01-05"), 5.0), (3, d("2020-01-04"), d("2020-01-04"), 0.0)],
        "order_id long, ship_date date, delivery_date date, shipping_fee double",
    )
    returns = spark.createDataFrame(
        [
            (1, 10, 1, "wrong size", d("2020-01-10")),
            (1, 10, 1, "damaged", d("2020-01-12")),
            (1, 10, 0, "damaged", d("2020-01-11")),
            (4, 11, 1, None, d("2020-03-05")),
            (None, 10, 9, "lost", d("2020-03-05")),
        ],
        "order_id long, product_id long, return_quantity int, return_reason string, return_date date",
    )
    reviews = spark.createDataFrame(
        [
            (1, 10, 2, d("2020-01-20")), (1, 10, 3, d("2020-01-21")),  # mean 2.5 -> 2
            (1, 11, 3, d("2020-01-20")), (1, 11, 4, d("2020-01-19")),  # mean 3.5 -> 4
        ],
        "order_id long, product_id long, rating int, review_date date",
    )
    products = spark.createDataFrame(
        [
            (10, "shirt", "Streetwear", "Basic", "M", "red", 100.0, 60.0),
            (11, "coat", "Outdoor", "Premium", "XL", "blue", 300.0, 150.0),
            (12, "cap", "Streetwear", "Basic", None, None, 50.0, 20.0),
        ],
        "product_id long, product_name string, category string, segment string, size string, "
        "color string, price double, cogs double",
    )
    promotions = spark.createDataFrame(
        [
            ("A", "ten", " Percentage ", 10.0, d("2020-01-01"), d("2020-01-02"), None, "email", 1, 500),
            ("F", "fifty", "fixed", 50.0, d("2020-02-01"), d("2020-02-10"), "Outdoor", "online", 0, 0),
        ],
        "promo_id string, promo_name string, promo_type string, discount_value double, start_date date, "
        "end_date date, applicable_category string, promo_channel string, stackable_flag int, "
        "min_order_value int",
    )
    customers = spark.createDataFrame(
        [
            (100, "1000", "Hue", d("2019-01-01"), "F", "18-24", "ads"),
            (101, "2000", "Hanoi", d("2019-01-02"), "M", "55+", "search"),
            (102, "9999", None, d("2019-01-03"), None, None, "ads"),
        ],
        "customer_id long, zip string, city string, signup_date date, gender string, "
        "age_group string, acquisition_channel string",
    )
    geography = spark.createDataFrame(
        [("1000", "Hue city", "Central", "D1"), ("2000", "Hanoi city", "North", "D2")],
        "zip string, city string, region string, district string",
    )
    names = (
        "order_items orders payments shipments returns reviews products promotions customers geography"
    ).split()
    local = locals()
    return {name: local[name] for name in names}
