"""Recursive multi-step forecast: every day's forecast feeds the next day's features.

A series is one row with the array of its days to come, and one column expression folds
over them: features from the last values, the score of both learners, and the forecast
appended to the values. The learners' trees are read from the form in which Spark writes
a model and travel as one row of arrays, as large as the models. So any number of series
are forecast side by side in one job. Everything known in advance (calendar, flags,
price index) comes with the days.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketide.functions.scalars import not_negative
from marketide.operators.model import FACTOR, TARGET, Ensemble
from marketide.operators.revenue import index_of_day
from marketide.operators.series import (
    EWM_SPANS,
    LAGS,
    ROLLING_MEANS,
    ROLLING_STDS,
    SINGLE,
    flag_holidays,
    flag_intervals,
    last_rows,
    one_per_series,
    with_calendar,
)
from marketide.session import materialise, remove, shared_dir

# Fixed value: days of history a forecast starts from.
HISTORY_ROWS = 60


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _tail(values: Column, n: int) -> Column:
    """The last n values, or all of a shorter array."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))


def _back(values: Column, n: int) -> Column:
    """The value n rows back; a shorter history gives its last value."""
    size = F.size(values)
    return F.get(values, F.when(size >= n, size - n).otherwise(size - 1))


def _mean(values: Column) -> Column:
    return _sum(values) / F.size(values)


def _deviation(values: Column) -> Column:
    """Sample deviation; missing for a single value."""
    size, mean = F.size(values), _mean(values)
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
    return F.when(size > 1, F.sqrt(squares / (size - 1)))


def _weighted_mean(values: Column, span: int) -> Column:
    decay = 1.0 - 2.0 / (span + 1.0)
    weighted = F.aggregate(values, F.lit(0.0), lambda total, x: total * decay + x)
    return weighted / F.aggregate(values, F.lit(0.0), lambda total, x: total * decay + 1.0)


def window_features(values: Column) -> dict[str, Column]:
    """Feature name -> its value from the revenue so far.

    Weighted means look back as many rows as their span here, not over all history.
    """
    lags = {f"{TARGET}_lag{n}": _back(values, n) for n in LAGS}
    means = {f"revenue_roll_mean_{n}_lag1": _mean(_tail(values, n)) for n in ROLLING_MEANS}
    deviations = {f"revenue_roll_std_{n}_lag1": _deviation(_tail(values, n)) for n in ROLLING_STDS}
    weighted = {f"revenue_ewma_{n}_lag1": _weighted_mean(_tail(values, n), n) for n in EWM_SPANS}
    difference = {"revenue_diff_lag1_lag7": _back(values, 1) - _back(values, 7)}
    return lags | difference | means | deviations | weighted


def future_days(
    targets: DataFrame,
    holidays: DataFrame | None = None,
    promotions: DataFrame | None = None,
    cpi: DataFrame | None = None,
) -> DataFrame:
    """What is known of each day to forecast: calendar, flags, price index."""
    days = with_calendar(targets)
    days = flag_intervals(flag_holidays(days, holidays), promotions)
    return index_of_day(days, cpi).withColumn("CPI", F.col(FACTOR) * 100.0)


def targets_per_series(history: DataFrame, days: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Every series with every day; the days travel as one array, as long as the horizon."""
    listed = days.agg(F.array_sort(F.collect_set("date"))).scalar()
    return history.select(*keys).distinct().withColumn("date", F.explode(listed))


def tree_row(spark: SparkSession, model: GBTRegressionModel) -> DataFrame:
    """A fitted learner as one row: arrays over the nodes of all trees, and the trees' roots and weights.

    A leaf leads to itself, so that all trees can be walked as far as the deepest.
    """
    path = f"{shared_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    node = F.col("nodeData")
    leaf = node["leftChild"] < 0
    # Nodes are numbered from 0 within their tree; numbers run on from tree to tree here.
    before = F.sum("n").over(Window.orderBy("treeID").rowsBetween(Window.unboundedPreceding, -1))
    weight = F.get(F.lit(list(model.treeWeights)), F.col("treeID"))
    stored = spark.read.parquet(f"{path}/data")
    trees = stored.groupBy("treeID").agg(F.count("*").alias("n")).select(
        "treeID", F.coalesce(before, F.lit(0)).cast("int").alias("root")
    )
    nodes = stored.join(trees, "treeID").select(
        (F.col("root") + node["id"]).alias("at"),
        F.when(leaf, 0).otherwise(node["split"]["featureIndex"]).alias("feature"),
        F.when(leaf, 0.0).otherwise(F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        (F.col("root") + F.when(leaf, node["id"]).otherwise(node["leftChild"])).alias("left"),
        (F.col("root") + F.when(leaf, node["id"]).otherwise(node["rightChild"])).alias("right"),
        node["prediction"].alias("value"),
    )
    listed = nodes.agg(F.sort_array(F.collect_list(F.struct(*nodes.columns))).alias("nodes"))
    roots = trees.agg(F.sort_array(F.collect_list(F.struct("root", weight.alias("weight")))).alias("trees"))
    arrays = [F.col("nodes")[c].alias(c) for c in nodes.columns[1:]]
    found = materialise(listed.join(roots).select("trees", *arrays))
    remove(spark, path)
    return found


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _score(learner: Column, depth: int, x: Column) -> Column:
    """The weighted sum of all trees of a learner for the features ``x``."""

    def child(node: Column, _: Column) -> Column:
        goes_left = F.get(x, F.get(learner["feature"], node)) <= F.get(learner["threshold"], node)
        return F.when(goes_left, F.get(learner["left"], node)).otherwise(F.get(learner["right"], node))

    def tree(total: Column, t: Column) -> Column:
        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), t["root"], child)
        return total + t["weight"] * F.get(learner["value"], leaf)

    return F.aggregate(learner["trees"], F.lit(0.0), tree)


def _named(keys: tuple[str, ...]) -> dict[str, str]:
    """The keys of a series by names that meet no other column here."""
    return {k: f"series_{i}" for i, k in enumerate(keys or SINGLE)}


def _starts(history: DataFrame, carried: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Per series its last HISTORY_ROWS values (oldest first) and the features of its last row."""
    past = one_per_series(last_rows(history, HISTORY_ROWS, "date", keys), keys)
    row = F.struct("date", F.col(TARGET).cast("double").alias("value"), *[F.col(c).cast("double").alias(c) for c in carried])
    names = _named(keys)
    rows = past.select(*[F.col(k).alias(n) for k, n in names.items()], row.alias("row"))
    listed = rows.groupBy(*names.values()).agg(F.sort_array(F.collect_list("row")).alias("past"))
    last = F.element_at("past", -1)
    return listed.select(
        *names.values(), F.col("past")["value"].alias("values"),
        F.struct(F.lit(1).alias("known"), *[last[c].alias(c) for c in carried]).alias("last"),
    )


def _days(future: DataFrame, known: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The days of each series in order, with what is known of them: one array, as long as the horizon."""
    given = [F.col(c).cast("double").alias(c) if c in future.columns else F.lit(None).cast("double").alias(c) for c in known]
    row = F.struct("date", F.col(FACTOR).cast("double").alias(FACTOR), F.array(*given).alias("given"))
    names = _named(keys)
    rows = one_per_series(future, keys).select(*[F.col(k).alias(n) for k, n in names.items()], row.alias("row"))
    return rows.groupBy(*names.values()).agg(F.sort_array(F.collect_list("row")).alias("days"))


def recursive_forecast(
    history: DataFrame,
    future: DataFrame,
    ensemble: Ensemble,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """(keys, date, real_revenue, revenue) for the rows of ``future``.

    ``history`` is the training matrix. Per day: features from the values so far, both
    learners, their mean in log space, expm1, no less than 0; the real value joins
    the values, the nominal one is the forecast. Features not known ahead keep the
    last value of the history. Series without history are forecast as NULL.
    """
    spark = history.sparkSession
    features = ensemble.features
    windows = window_features(F.col("values"))
    known = [c for c in features if c not in windows]
    names = list(_named(keys).values())
    days, starts = _days(future, known, keys), _starts(history, known, keys)
    same = reduce(Column.__and__, [days[n].eqNullSafe(starts[n]) for n in names])
    rows = days.join(starts, same, "left").select(*[days[n] for n in names], "days", "values", "last")
    learners = [f"learner_{i}" for i in range(len(ensemble.models))]
    for name, model in zip(learners, ensemble.models):
        # One row, as large as the model.
        row = tree_row(spark, model)
        rows = rows.join(F.broadcast(row.select(F.struct(*row.columns).alias(name))))
    depths = [max(t.depth for t in m.trees) for m in ensemble.models]

    def step(values: Column, day: Column) -> Column:
        made = window_features(values)
        vector = []
        for c in features:
            if c in made:
                value = made[c]
            else:
                given = F.get(day["given"], F.lit(known.index(c)))
                value = F.coalesce(F.when(~F.isnan(given), given), F.col("last")[c])
            vector.append(F.coalesce(value, F.lit(float("nan"))))
        logs = lambda x: sum((_score(F.col(n), d, x) for n, d in zip(learners, depths)), F.lit(0.0)) / len(learners)
        real = _let(F.array(*vector), lambda x: not_negative(F.expm1(logs(x))))
        return F.concat(values, F.array(real))

    folded = rows.withColumn("made", F.aggregate("days", F.col("values"), step))
    placed = folded.select(*names, "made", F.size("values").alias("past"), F.posexplode("days").alias("nth", "day"))
    real = F.get("made", F.col("past") + F.col("nth"))
    kinds = dict(history.dtypes)
    return placed.select(
        *[F.col(n).cast(kinds[k]).alias(k) for n, k in zip(names, keys)],
        F.col("day.date").cast(kinds["date"]).alias("date"), real.alias("real_revenue"),
        (real * F.col("day")[FACTOR]).alias("revenue"),
    )


def merge_submission(sample: DataFrame, forecast: DataFrame) -> DataFrame:
    """The sample's days with the forecast as Revenue; COGS is passed through."""
    values = forecast.select(F.col("date").alias("Date"), F.col("revenue").alias("Revenue"))
    return sample.drop("Revenue").join(values, "Date", "left").select("Date", "Revenue", "COGS")
