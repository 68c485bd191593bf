"""Recursive forecast by a linear model of the series' own past, in column expressions alone.

A day is a + b * (day before) + c * (seven days before), fitted per series by least
squares; forecasts take the place of days that have not come yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.scalars import not_negative
from marketide.operators.series import SINGLE, one_per_series

SHORT, LONG = 1, 7


def fit_lags(history: DataFrame, value: str, day: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    """Per series the intercept and the weights of the two lags; lags count rows.

    A series whose lags do not vary apart (or one too short) has no weights: NULL.
    """
    order = Window.partitionBy(*keys).orderBy(day)
    lagged = history.select(
        *keys, F.col(value).alias("y"),
        F.lag(value, SHORT).over(order).alias("x"), F.lag(value, LONG).over(order).alias("z"),
    ).where("y IS NOT NULL AND x IS NOT NULL AND z IS NOT NULL")
    moments = lagged.groupBy(*keys).agg(
        F.avg("y").alias("my"), F.avg("x").alias("mx"), F.avg("z").alias("mz"),
        F.var_pop("x").alias("vx"), F.var_pop("z").alias("vz"),
        F.covar_pop("x", "z").alias("cxz"), F.covar_pop("x", "y").alias("cxy"), F.covar_pop("z", "y").alias("czy"),
    )
    spread = F.col("vx") * F.col("vz") - F.col("cxz") * F.col("cxz")
    weighted = moments.withColumns({
        "short": F.try_divide(F.col("cxy") * F.col("vz") - F.col("czy") * F.col("cxz"), spread),
        "long": F.try_divide(F.col("czy") * F.col("vx") - F.col("cxy") * F.col("cxz"), spread),
    })
    start = F.col("my") - F.col("short") * F.col("mx") - F.col("long") * F.col("mz")
    return weighted.select(*keys, start.alias("start"), "short", "long")


def forecast_lags(
    history: DataFrame, days: DataFrame, value: str, day: str = "date", keys: tuple[str, ...] = ()
) -> DataFrame:
    """keys, day and forecast of every day in ``days``, in the order of days; never below zero.

    The fold over the days carries the series' last LONG values; series are side by side.
    Series with fewer than LONG values, or without weights, are forecast as NULL.
    """
    by = list(keys or SINGLE)
    past = one_per_series(history.where(F.col(value).isNotNull()), keys)
    last = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(day)))
    pair = F.struct(F.col(day).alias("d"), F.col(value).alias("v"))
    recent = (
        past.withColumn("_last", last).where(F.col("_last") <= LONG)
        .groupBy(*by).agg(F.sort_array(F.collect_list(pair)).alias("recent"))
        .withColumn("recent", F.transform("recent", lambda p: p["v"]))
    )
    targets = one_per_series(days.select(*keys, day), keys).groupBy(*by).agg(
        F.sort_array(F.collect_set(day)).alias("targets")
    )
    weights = one_per_series(fit_lags(history, value, day, keys), keys)
    series = targets.join(recent, by, "left").join(weights, by, "left")

    def step(values: Column, _: Column) -> Column:
        n = F.size(values)
        short, long = F.get(values, n - SHORT), F.get(values, n - LONG)
        found = F.col("start") + F.col("short") * short + F.col("long") * long
        return F.concat(values, F.array(F.when(found.isNotNull(), not_negative(found))))

    known = F.coalesce("recent", F.array().cast("array<double>"))
    folded = series.withColumn("_values", F.aggregate("targets", known, step)).withColumn("_known", F.size(known))
    rows = folded.select(*by, "_known", "_values", F.posexplode("targets").alias("_at", day))
    return rows.select(*keys, day, F.get("_values", F.col("_known") + F.col("_at")).alias("forecast"))
