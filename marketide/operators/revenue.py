"""Discounts, net revenue, gross profit, price-index adjustment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.scalars import clean_label, exact_sum, smaller_or_missing
from marketide.operators.skew import DEFAULT, Spread, join_spread

PROMOTION_TERMS = ("promo_type", "discount_value", "min_order_value")


def order_totals(lines: DataFrame) -> DataFrame:
    """Undiscounted value per order.

    An aggregate joined back, not a window: a window would sort a whole order in
    one task, while partial sums shrink even the largest order to a row per split.
    """
    base = F.col("unit_price") * F.col("quantity")
    return lines.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        exact_sum(base).alias("order_base_total")
    )


def with_order_total(lines: DataFrame) -> DataFrame:
    """``lines`` with the undiscounted value of their order, which must be here whole; NULL without an order.

    For orders that fit a task: what is placed by order for their joins is not placed once more for the totals.
    """
    total = exact_sum(F.col("unit_price") * F.col("quantity"), Window.partitionBy("order_id"))
    return lines.withColumn("order_base_total", F.when(F.col("order_id").isNotNull(), total))


def attach_promotions(
    lines: DataFrame,
    promotions: DataFrame,
    columns: tuple[str, ...] = PROMOTION_TERMS,
    probe: DataFrame | None = None,
    spread: Spread = DEFAULT,
) -> DataFrame:
    """Promotion terms per line. Lines without a promotion stay, whatever their number."""
    terms = promotions.select("promo_id", *columns)
    return join_spread(lines, terms, ["promo_id"], "left", probe, spread)


def with_net_revenue(
    lines: DataFrame,
    clean_type: bool = True,
    valid_on: str | None = None,
    day: str = "order_date",
) -> DataFrame:
    """Add ``base_revenue``, ``final_discount`` and ``actual_revenue``.

    Needs unit_price, quantity, order_base_total and the promotion terms. A fixed
    discount is taken once per line; the order minimum is compared with the total
    of the order; a discount never exceeds the line's own value.

    ``clean_type=False`` compares the type label as it is written, without lowering
    and trimming. ``valid_on="dates"`` also asks that the order day lies inside the
    promotion's dates (then start_date and end_date are needed); off by default.
    """
    base = F.col("unit_price") * F.col("quantity")
    kind = clean_label("promo_type") if clean_type else F.coalesce(F.col("promo_type"), F.lit("none"))
    value = F.coalesce(F.col("discount_value"), F.lit(0.0))
    minimum = F.coalesce(F.col("min_order_value"), F.lit(0))
    percentage = F.when(kind == "percentage", base * (value / 100.0)).otherwise(F.lit(0.0))
    fixed = F.when(kind == "fixed", value).otherwise(F.lit(0.0))
    allowed = F.col("order_base_total") >= minimum
    if valid_on == "dates":
        allowed = allowed & F.col(day).between(F.col("start_date"), F.col("end_date"))
    granted = F.when(allowed, percentage + fixed).otherwise(F.lit(0.0))
    return (
        lines.withColumn("base_revenue", base)
        .withColumn("final_discount", smaller_or_missing(granted, F.col("base_revenue")))
        .withColumn("actual_revenue", F.col("base_revenue") - F.col("final_discount"))
    )


def gross_profit() -> Column:
    return F.col("actual_revenue") - F.col("cogs") * F.col("quantity")


def last_index(cpi: DataFrame) -> DataFrame:
    """One row: the index of the latest month."""
    return cpi.agg(F.max_by("CPI", "month_start").alias("CPI"))


def index_of_day(days: DataFrame, cpi: DataFrame | None, day: str = "date") -> DataFrame:
    """Add ``inflation_factor`` of each day's month; months not listed take the latest one."""
    if cpi is None:
        return days.withColumn("inflation_factor", F.lit(1.0))
    monthly = cpi.select(
        F.trunc("month_start", "month").alias("index_month"), F.col("CPI").alias("index_value")
    )
    keyed = days.withColumn("index_month", F.trunc(day, "month"))
    latest = last_index(cpi).scalar()
    return (
        keyed.join(monthly, "index_month", "left")
        .withColumn("inflation_factor", F.coalesce(F.col("index_value"), latest) / 100.0)
        .drop("index_month", "index_value")
    )


def deflate(
    series: DataFrame,
    cpi: DataFrame | None,
    value: str = "actual_revenue",
    day: str = "date",
    partition_by: tuple[str, ...] = (),
    real: str | None = None,
) -> DataFrame:
    """Join the month's index, fill gaps forward and then backward, divide ``value`` by it.

    ``real`` names the deflated column; by default it replaces ``value``. Without an
    index the factor is 1 (index 100).
    """
    out = real or value
    if cpi is None:
        indexed = series.withColumn("CPI", F.lit(100.0))
    else:
        monthly = cpi.select(F.trunc("month_start", "month").alias("index_month"), "CPI")
        joined = (
            series.withColumn("index_month", F.trunc(day, "month"))
            .join(monthly, "index_month", "left")
            .drop("index_month")
        )
        indexed = joined.withColumn("CPI", filled("CPI", day, partition_by))
    factor = F.col("CPI") / 100.0
    return indexed.withColumn("inflation_factor", factor).withColumn(out, F.col(value) / factor)


def filled(column: str, order_by: str, partition_by: tuple[str, ...] = ()) -> Column:
    """The last known value; before the first one, the first."""
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(
        F.last(column, ignorenulls=True).over(before), F.first(column, ignorenulls=True).over(after)
    )
