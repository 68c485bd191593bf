"""Boosted-tree models of daily revenue: fit, search, evaluate, explain.

Targets are fitted as log1p of real revenue; two learners are averaged in log space.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from functools import cached_property, partial
from typing import TypeVar

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from marketide.functions.metrics import error_metrics, rmse
from marketide.operators.encode import scaler_stages
from marketide.operators.errors import error_table
from marketide.operators.series import expanding_folds
from marketide.session import materialise

TARGET = "actual_revenue"
LABEL = "log_target"
FACTOR = "inflation_factor"
T = TypeVar("T")


@dataclass(frozen=True)
class Learner:
    """Settings of one boosted-tree regression."""

    trees: int = 100
    rate: float = 0.1
    depth: int = 5
    seed: int = 42


# Ranges the search draws from, number of trials and folds.
TREE_RANGE = (100, 400)
RATE_RANGE = (0.01, 0.1)
DEPTH_RANGE = (3, 6)
TRIALS = 5
FOLDS = 3
# Fixed value: trees without gain on held-out rows before boosting stops.
PATIENCE = 30

#: Fits that run at the same time, and rows of a fit that one task takes.
FITS_AT_ONCE, ROWS_PER_TASK = 12, 50_000
#: Trees after which patience is first looked at.
FIRST_TREES = 64

SHALLOW = Learner(depth=3)
DEEP = Learner(depth=5)


def with_label(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumn(LABEL, F.log1p(target))


def regressor(learner: Learner, out: str = "prediction") -> GBTRegressor:
    return GBTRegressor(
        labelCol=LABEL, featuresCol="features", predictionCol=out, maxIter=learner.trees,
        stepSize=learner.rate, maxDepth=learner.depth, seed=learner.seed,
    )


def best_prefix(errors: list[float], patience: int = PATIENCE) -> int:
    """How many trees to keep: up to the least error before ``patience`` trees in a row bring no gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model as it was after ``n`` trees."""
    context = SparkSession.active().sparkContext
    regression = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(model.trees[:n], model.treeWeights)):
        trees[i], weights[i] = tree._java_obj, weight
    return GBTRegressionModel(regression.GBTRegressionModel(model.uid, trees, weights))


def fit_patiently(rows: DataFrame, held_out: DataFrame, learner: Learner, patience: int = PATIENCE) -> GBTRegressionModel:
    """A learner that stops adding trees when ``held_out`` has not gained for ``patience`` of them.

    The errors of all prefixes are found for one fitted model, which is then cut. Boosting
    is begun with FIRST_TREES and twice as many each time, as long as patience lasts; the
    first trees of a longer fit are those of a shorter one. Without held-out rows all stay.
    """
    if held_out.isEmpty():
        return regressor(learner).fit(rows)
    trees = min(FIRST_TREES, learner.trees)
    while True:
        model = regressor(replace(learner, trees=trees)).fit(rows)
        best = best_prefix(model.evaluateEachIteration(held_out, "squared"), patience)
        if trees == learner.trees or best + patience <= trees:
            return first_trees(model, best)
        trees = min(2 * trees, learner.trees)


def side_by_side(tasks: list[Callable[[], T]], at_once: int = FITS_AT_ONCE) -> list[T]:
    """The results of all tasks, in order. Their Spark jobs run at the same time, each task's in a pool of its own."""
    session = SparkSession.active()

    def run(numbered: tuple[int, Callable[[], T]]) -> T:
        session.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{numbered[0]}")
        return numbered[1]()

    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as threads:
        # A target made here takes this thread's local properties along.
        return [f.result() for f in [threads.submit(inheritable_thread_target(session)(run), t) for t in enumerate(tasks)]]


@dataclass(frozen=True)
class Ensemble:
    """Fitted learners and the order of their features."""

    features: list[str]
    models: list[GBTRegressionModel]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the forecast in the target's own unit."""
        scored = self.log_mean(assembled(df, self.features), out)
        return scored.withColumn(out, F.expm1(out)).drop("features")

    @cached_property
    def _named(self) -> dict[str, GBTRegressionModel]:
        """Every learner by the column it writes."""
        return {f"log_{i}": m.copy({m.predictionCol: f"log_{i}"}) for i, m in enumerate(self.models)}

    def log_mean(self, df: DataFrame, out: str) -> DataFrame:
        """Add the learners' mean in log space to rows with assembled ``features``."""
        for model in self._named.values():
            df = model.transform(df)
        mean = sum((F.col(n) for n in self._named), F.lit(0.0)) / len(self._named)
        return df.withColumn(out, mean).drop(*self._named)


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def prepared(train: DataFrame, features: list[str], *more: str) -> DataFrame:
    """Assembled rows for fitting, in as many partitions as their number asks for.

    A fit runs some jobs per tree, so a day-grain table in many small partitions would
    spend its time on starting tasks.
    """
    rows = assembled(with_label(train), features).select("features", LABEL, *more)
    count = train.count()
    return materialise(rows.coalesce(max(1, -(-count // ROWS_PER_TASK))))


def fit_ensemble(
    train: DataFrame, features: list[str], learners: tuple[Learner, ...] = (SHALLOW, DEEP), early_stop: str | None = None
) -> Ensemble:
    """Fit every learner on ``train``, side by side; refitting on all rows is a second call.

    ``early_stop`` names a boolean column: its true rows are not learned from and decide
    when to stop adding trees.
    """
    more = [early_stop] if early_stop else []
    rows = prepared(train, features, *more)
    if early_stop:
        learned, held = rows.where(~F.col(early_stop)), rows.where(F.col(early_stop))
        tasks = [partial(fit_patiently, learned, held, learner) for learner in learners]
    else:
        tasks = [partial(regressor(learner).fit, rows) for learner in learners]
    return Ensemble(features, side_by_side(tasks))


def nominal(column: str) -> Column:
    return F.col(column) * F.col(FACTOR)


def evaluate(ensemble: Ensemble, test: DataFrame) -> DataFrame:
    """One row of MAE, RMSE, R2, MAPE in nominal money."""
    scored = ensemble.predict(test)
    return scored.agg(*error_metrics(nominal(TARGET), nominal("prediction")))


def model_errors(ensemble: Ensemble, test: DataFrame) -> DataFrame:
    return error_table(ensemble.predict(test), TARGET, "prediction", FACTOR)


def scaled_pipeline_r2(
    train: DataFrame, test: DataFrame, features: list[str], learner: Learner = DEEP
) -> float:
    """R2 in log space of a scale-then-regress pipeline."""
    pipeline = Pipeline(stages=[*scaler_stages(features), regressor(learner)])
    scored = pipeline.fit(with_label(train)).transform(with_label(test))
    return RegressionEvaluator(labelCol=LABEL, metricName="r2").evaluate(scored)


def draw_learners(
    trials: int = TRIALS, seed: int = 42, tree_range: tuple[int, int] = TREE_RANGE
) -> list[tuple[Learner, Learner]]:
    """Seeded random settings for both learners of each trial; the rate is log-uniform."""
    source = random.Random(seed)

    def draw() -> Learner:
        rate = math.exp(source.uniform(*(math.log(r) for r in RATE_RANGE)))
        return Learner(source.randint(*tree_range), rate, source.randint(*DEPTH_RANGE), seed)

    return [(draw(), draw()) for _ in range(trials)]


@dataclass(frozen=True)
class Trial:
    trial: int
    learners: tuple[Learner, Learner]
    scores: tuple[float, ...]

    @property
    def mean_rmse(self) -> float:
        return sum(self.scores) / len(self.scores)


def search(
    train: DataFrame,
    features: list[str],
    trials: int = TRIALS,
    folds: int = FOLDS,
    seed: int = 42,
    tree_range: tuple[int, int] = TREE_RANGE,
    keys: tuple[str, ...] = (),
) -> list[Trial]:
    """Expanding-window validation of random settings, best mean RMSE first.

    Each fold trains on earlier rows only and stops adding trees when its own rows
    stop improving. All fits of all trials run side by side on folds that are written
    once; one number per fold and trial comes back to the driver.
    """
    folded = materialise(expanding_folds(train, folds, "date", keys))
    drawn = draw_learners(trials, seed, tree_range)
    parts = [
        folded.where(F.col("fold") <= fold).withColumn("held_out", F.col("fold") == fold) for fold in range(1, folds + 1)
    ]
    ready = [prepared(rows, features, "held_out") for rows in parts]
    fits = [
        partial(fit_patiently, rows.where("NOT held_out"), rows.where("held_out"), learner)
        for learners in drawn for rows in ready for learner in learners
    ]
    models = iter(side_by_side(fits))
    ensembles = [
        (Ensemble(features, [next(models) for _ in learners]), rows.where("held_out")) for learners in drawn for rows in parts
    ]
    measure = rmse(nominal(TARGET), nominal("prediction"))
    scores = iter(side_by_side([lambda e=e, held=held: e.predict(held).agg(measure).first()[0] for e, held in ensembles]))
    results = [Trial(i, learners, tuple(next(scores) for _ in parts)) for i, learners in enumerate(drawn)]
    return sorted(results, key=lambda trial: (trial.mean_rmse, trial.trial))


def search_table(df: DataFrame, results: list[Trial]) -> DataFrame:
    """The trials, one row per learner."""
    rows = [
        {"trial": r.trial, "learner": j, **asdict(learner), "mean_rmse": r.mean_rmse}
        for r in results for j, learner in enumerate(r.learners)
    ]
    return df.sparkSession.createDataFrame(
        rows, "trial int, learner int, trees int, rate double, depth int, seed int, mean_rmse double"
    )


def best_learners(results: list[Trial]) -> tuple[Learner, Learner]:
    """Settings of the best trial; the final fits use them without early stopping."""
    return results[0].learners


def importance(ensemble: Ensemble, df: DataFrame, model: int = 0, top: int = 10) -> DataFrame:
    """The ``top`` features by split gain of one learner."""
    weights = ensemble.models[model].featureImportances
    rows = [(name, float(weights[i])) for i, name in enumerate(ensemble.features)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def permutation_importance(
    ensemble: Ensemble, test: DataFrame, keys: tuple[str, ...] = (), seed: int = 42
) -> DataFrame:
    """(feature, rmse, delta_rmse): how much worse the forecast gets if a feature is shuffled.

    Every row is repeated once per feature, with that feature's value taken from
    another row of the same series; all features are scored in one pass. The shuffle
    orders rows by a hash, so a retried task draws the same one.
    """
    features = ensemble.features
    base = test.select(*keys, "date", TARGET, FACTOR, *features)
    exploded = base.withColumn(
        "shuffled", F.explode(F.array(*[F.lit(f) for f in ["", *features]]))
    )
    key = ["shuffled", *keys]
    chosen = F.coalesce(*[F.when(F.col("shuffled") == f, F.col(f).cast("double")) for f in features])
    ordered = Window.partitionBy(*key).orderBy("date")
    mixed = Window.partitionBy(*key).orderBy(F.xxhash64("date", "shuffled", F.lit(seed)), "date")
    receivers = exploded.withColumn("slot", F.row_number().over(ordered))
    givers = exploded.select(*key, chosen.alias("given"), F.row_number().over(mixed).alias("slot"))
    swapped = receivers.join(givers, [*key, "slot"])
    columns = [
        F.when(F.col("shuffled") == f, F.col("given")).otherwise(F.col(f).cast("double")).alias(f)
        for f in features
    ]
    rows = swapped.select(*key, "date", TARGET, FACTOR, *columns)
    scores = ensemble.predict(rows).groupBy("shuffled").agg(
        rmse(nominal(TARGET), nominal("prediction")).alias("rmse")
    )
    whole = F.max(F.when(F.col("shuffled") == "", F.col("rmse"))).over(Window.partitionBy())
    return (
        scores.withColumn("delta_rmse", F.col("rmse") - whole)
        .where(F.col("shuffled") != "")
        .withColumnRenamed("shuffled", "feature")
    )
