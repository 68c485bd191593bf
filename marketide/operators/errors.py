"""Error tables and reports on forecasts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.metrics import error_metrics, mae, mape, rmse


def error_table(df: DataFrame, actual: str, predicted: str, factor: str | None = None) -> DataFrame:
    """(date, actual, pred, abs_error); ``factor`` turns real amounts into nominal ones."""
    scale = F.col(factor) if factor else F.lit(1.0)
    a, p = F.col(actual) * scale, F.col(predicted) * scale
    return df.select(
        "date", a.alias("actual"), p.alias("pred"), F.abs(a - p).alias("abs_error")
    )


def naive_forecast(
    daily: DataFrame, value: str = "actual_revenue", lag: int = 7, keys: tuple[str, ...] = ()
) -> DataFrame:
    """The value ``lag`` rows earlier as the forecast, rows without one left out."""
    w = Window.partitionBy(*keys).orderBy("date")
    forecast = daily.withColumn("naive", F.lag(value, lag).over(w)).where(F.col("naive").isNotNull())
    return error_table(forecast, value, "naive")


def error_summary(errors: DataFrame) -> DataFrame:
    """One row: MAE, RMSE, MAPE, smallest, largest and standard deviation of the error."""
    a, p = F.col("actual"), F.col("pred")
    return errors.agg(
        F.count("*").alias("n"),
        mae(a, p).alias("mae"),
        rmse(a, p).alias("rmse"),
        mape(a, p).alias("mape"),
        F.min("abs_error").alias("min_error"),
        F.max("abs_error").alias("max_error"),
        F.stddev_samp("abs_error").alias("std_error"),
    )


def metrics(errors: DataFrame) -> DataFrame:
    """One row: MAE, RMSE, R2, MAPE, n."""
    return errors.agg(*error_metrics(F.col("actual"), F.col("pred")))


def monthly_errors(errors: DataFrame) -> DataFrame:
    """MAE and number of days per calendar month."""
    return errors.groupBy(F.month("date").alias("month")).agg(
        F.avg("abs_error").alias("mae"), F.count("*").alias("n")
    )


def extreme_months(errors: DataFrame) -> DataFrame:
    """(kind, month, mae) of the worst and the best month; ties go to the earlier month."""
    monthly = monthly_errors(errors)
    worst = monthly.agg(F.max_by(F.struct("month", "mae"), F.struct("mae", -F.col("month"))).alias("m"))
    best = monthly.agg(F.min_by(F.struct("month", "mae"), F.struct("mae", "month")).alias("m"))
    return worst.select(F.lit("worst").alias("kind"), "m.*").unionByName(
        best.select(F.lit("best").alias("kind"), "m.*")
    )


def extreme_days(errors: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` days with the largest and the ``n`` with the smallest error."""
    worst = errors.orderBy(F.desc("abs_error"), "date").limit(n)
    best = errors.orderBy("abs_error", "date").limit(n)
    return worst.withColumn("kind", F.lit("worst")).unionByName(best.withColumn("kind", F.lit("best")))


def _correlation(a: Column, b: Column) -> Column:
    """Pearson correlation, NULL for a constant (where ``corr`` divides by zero under ANSI)."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, target: str, features: Iterable[str]) -> DataFrame:
    """(feature, correlation_score): size of the Pearson correlation with ``target``, one pass."""
    names = list(features)
    y = F.col(target).cast("double")
    row = df.agg(*[F.abs(_correlation(F.col(f"`{c}`").cast("double"), y)).alias(c) for c in names])
    return row.unpivot([], names, "feature", "correlation_score")
