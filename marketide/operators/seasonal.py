"""Seasonal-growth forecast: base level x yearly growth x seasonal factor.

Works on day-grain sales (date, Revenue, COGS); both amounts are forecast alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.metrics import mape

AMOUNTS = {"Revenue": "rev", "COGS": "cogs"}

# Fixed value: a year has this many days for the base level, leap years too.
BASE_DAYS = 365


def as_sales(daily: DataFrame) -> DataFrame:
    """A daily series as (date, Revenue, COGS)."""
    return daily.select(
        "date",
        F.col("actual_revenue").alias("Revenue"),
        (F.col("actual_revenue") - F.col("gross_profit")).alias("COGS"),
    )


def annual_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.year("date").alias("year")).agg(
        *[F.sum(a).alias(a) for a in AMOUNTS]
    )


def yoy_growth(annual: DataFrame, first: int, last: int) -> DataFrame:
    """Relative change to the year before, for full years ``first`` to ``last``."""
    w = Window.orderBy("year")
    changes = {
        f"{short}_growth": F.try_divide(F.col(a), F.lag(a).over(w)) - 1 for a, short in AMOUNTS.items()
    }
    years = annual.where(F.col("year").between(first, last)).withColumns(changes)
    return years.where(F.col("rev_growth").isNotNull()).select("year", *changes)


def mean_growth(annual: DataFrame, first: int, last: int) -> DataFrame:
    """One row: the geometric mean of the yearly growth factors."""
    def factor(change: str) -> Column:
        return F.pow(F.product(1 + F.col(change)), F.lit(1.0) / F.count(change))

    return yoy_growth(annual, first, last).agg(
        *[factor(f"{short}_growth").alias(f"growth_{short}") for short in AMOUNTS.values()]
    )


def seasonal_profile(sales: DataFrame) -> DataFrame:
    """Mean of amount / yearly mean amount, per (month, day)."""
    year = Window.partitionBy(F.year("date"))
    normed = {
        f"{short}_norm": F.try_divide(F.col(a), F.avg(a).over(year)) for a, short in AMOUNTS.items()
    }
    return (
        sales.withColumns(normed)
        .groupBy(F.month("date").alias("month"), F.day("date").alias("day"))
        .agg(*[F.avg(n).alias(n) for n in normed])
    )


def seasonal_forecast(
    sales: DataFrame, days: DataFrame, base_year: int, first: int, last: int, digits: int | None = 2
) -> DataFrame:
    """(date, Revenue_pred, COGS_pred) for ``days``; (month, day) without history has factor 1."""
    annual = annual_totals(sales)
    base = annual.where(F.col("year") == base_year)
    growth = mean_growth(annual, first, last)
    dated = days.withColumns({"month": F.month("date"), "day": F.day("date")})
    joined = dated.join(seasonal_profile(sales), ["month", "day"], "left")
    ahead = F.year("date") - base_year
    forecasts = []
    for amount, short in AMOUNTS.items():
        level = base.select(F.sum(amount) / BASE_DAYS).scalar()
        yearly = growth.select(f"growth_{short}").scalar()
        value = level * F.pow(yearly, ahead) * F.coalesce(F.col(f"{short}_norm"), F.lit(1.0))
        forecasts.append((value if digits is None else F.bround(value, digits)).alias(f"{amount}_pred"))
    kept = [c for c in days.columns if c != "date"]
    return joined.select("date", *kept, *forecasts)


def seasonal_validation(
    sales: DataFrame, years: list[int], base_year: int, first: int, last: int
) -> DataFrame:
    """One row: MAPE of the forecast on past years."""
    past = sales.where(F.year("date").isin(years))
    forecast = seasonal_forecast(sales, past, base_year, first, last, digits=None)
    return forecast.agg(
        *[mape(F.col(a), F.col(f"{a}_pred")).alias(f"mape_{short}") for a, short in AMOUNTS.items()]
    )


def submission(forecast: DataFrame) -> DataFrame:
    """The forecast under its published names, dates as text."""
    return forecast.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.col("Revenue_pred").alias("Revenue"),
        F.col("COGS_pred").alias("COGS"),
    )
