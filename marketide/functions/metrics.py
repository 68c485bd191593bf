"""Forecast quality as aggregate expressions, one pass each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - residual / total sum of squares. Rows with a NULL on either side do not count."""
    both = actual.isNotNull() & predicted.isNotNull()
    residual = F.sum((actual - predicted) * (actual - predicted))
    total = F.var_pop(F.when(both, actual)) * F.count(F.when(both, actual))
    return F.lit(1.0) - F.try_divide(residual, total)


def mape(actual: Column, predicted: Column) -> Column:
    """Mean of |error| / actual. A zero actual counts as infinite error, unless also forecast as 0."""
    missed = F.when(predicted != 0, F.lit(float("inf")))
    share = F.when(actual == 0, missed).otherwise(F.try_divide(F.abs(actual - predicted), actual))
    return F.avg(share) * 100


def error_metrics(actual: Column, predicted: Column) -> list[Column]:
    return [
        mae(actual, predicted).alias("mae"),
        rmse(actual, predicted).alias("rmse"),
        r2(actual, predicted).alias("r2"),
        mape(actual, predicted).alias("mape"),
        F.count(actual - predicted).alias("n"),
    ]
