"""Boosted trees and the recursive forecast."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import d, rows
from marketide.operators import forecast, model, series
from marketide.session import materialise

LEARNERS = (model.Learner(trees=3, rate=0.3, depth=2), model.Learner(trees=4, rate=0.3, depth=3))


def make_daily(spark, n=200, keys=(None,)):
    data = []
    for k, key in enumerate(keys):
        rng = np.random.default_rng(k)
        for i, day in enumerate(pd.date_range("2019-01-01", periods=n).date):
            value = 1000.0 * (k + 1) + 300 * np.sin(2 * np.pi * i / 7) + rng.normal(0, 20)
            data.append((key or "all", day, float(value), 100 + i % 13))
    return spark.createDataFrame(data, "store string, date date, actual_revenue double, sessions long")


@pytest.fixture(scope="module")
def matrix(spark):
    daily = make_daily(spark)
    traffic = daily.select("date", "sessions")
    built = series.training_matrix(daily.drop("store", "sessions"), traffic=traffic)
    return materialise(built.coalesce(1))


@pytest.fixture(scope="module")
def features(matrix):
    return series.feature_columns(matrix.columns)


@pytest.fixture(scope="module")
def split(matrix):
    parts = series.chrono_split(matrix)
    return parts.where("is_train = 1").drop("is_train"), parts.where("is_train = 0").drop("is_train")


@pytest.fixture(scope="module")
def ensemble(split, features):
    return model.fit_ensemble(split[0], features, LEARNERS)


def test_ensemble_is_the_mean_in_log_space_and_repeatable(ensemble, split, features):
    scored = ensemble.predict(split[1]).orderBy("date").toPandas()
    vectors = model.assembled(split[1], features)
    logs = [
        m.transform(vectors).orderBy("date").toPandas().prediction.to_numpy() for m in ensemble.models
    ]
    assert scored.prediction.tolist() == pytest.approx(np.expm1((logs[0] + logs[1]) / 2).tolist())
    again = model.fit_ensemble(split[0], features, LEARNERS).predict(split[1]).orderBy("date").toPandas()
    assert again.prediction.tolist() == scored.prediction.tolist()


def test_it_beats_the_mean(ensemble, split):
    got = model.evaluate(ensemble, split[1]).first()
    assert got.n == split[1].count() and got.r2 > 0.5
    table = model.model_errors(ensemble, split[1])
    assert table.columns == ["date", "actual", "pred", "abs_error"]
    assert table.agg(F.avg("abs_error")).first()[0] == pytest.approx(got.mae)


def test_importance(ensemble, matrix, split, features):
    top = model.importance(ensemble, matrix, top=5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance
    assert sum(ensemble.models[0].featureImportances) == pytest.approx(1.0)
    permuted = {r.feature: r for r in model.permutation_importance(ensemble, split[1]).collect()}
    assert set(permuted) == set(features)
    plain = model.evaluate(ensemble, split[1]).first().rmse
    for r in permuted.values():
        assert r.rmse - r.delta_rmse == pytest.approx(plain)
    unused = set(features) - {
        features[i] for m in ensemble.models for i in m.featureImportances.indices
    }
    assert unused and all(permuted[f].delta_rmse == pytest.approx(0.0, abs=1e-9) for f in unused)
    used = [permuted[f].delta_rmse for f in features if f not in unused]
    assert max(used) > 0


def test_search(split, features):
    drawn = model.draw_learners(50, seed=1)
    assert drawn == model.draw_learners(50, seed=1)
    for pair in drawn:
        for learner in pair:
            assert 100 <= learner.trees <= 400 and 0.01 <= learner.rate <= 0.1 and 3 <= learner.depth <= 6
    results = model.search(split[0], features, trials=2, folds=2, tree_range=(1, 2))
    assert [len(r.scores) for r in results] == [2, 2]
    assert results[0].mean_rmse <= results[1].mean_rmse
    table = model.search_table(split[0], results)
    assert table.count() == 4
    assert model.best_learners(results) == results[0].learners


def test_best_prefix():
    assert model.best_prefix([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert model.best_prefix([3.0, 2.0, 2.5, 2.4, 1.0], patience=3) == 5
    assert model.best_prefix([1.0], patience=1) == 1


def test_patience_equals_refitting_every_prefix(split, features, monkeypatch):
    rows_, held = (model.prepared(part, features) for part in split)
    learner = model.Learner(trees=9, rate=0.9, depth=2)
    error = F.avg((F.col(model.LABEL) - F.col("prediction")) ** 2)
    prefixes = [model.regressor(model.Learner(n, 0.9, 2)).fit(rows_) for n in range(1, 10)]
    errors = [m.transform(held).agg(error).first()[0] for m in prefixes]
    assert prefixes[-1].evaluateEachIteration(held, "squared") == pytest.approx(errors)
    for patience in (1, 2, 9):
        for first in (2, 64):
            monkeypatch.setattr(model, "FIRST_TREES", first)
            cut = model.fit_patiently(rows_, held, learner, patience)
            n = model.best_prefix(errors, patience)
            assert cut.getNumTrees == n
            expected = prefixes[n - 1].transform(held).select("prediction").collect()
            assert cut.transform(held).select("prediction").collect() == expected
    everything = model.fit_patiently(rows_, held.where("false"), learner)
    assert everything.getNumTrees == 9


def test_side_by_side_keeps_the_order(spark):
    found = model.side_by_side([lambda n=n: spark.range(n).count() for n in range(12)], at_once=5)
    assert found == list(range(12))
    assert model.side_by_side([]) == []


def test_scaled_pipeline(split, features):
    assert model.scaled_pipeline_r2(*split, features, LEARNERS[1]) > 0.5


def scorer(ensemble):
    """The learners' mean of one row, in the target's own unit."""
    return lambda x: float(np.expm1(np.mean([m.predict(Vectors.dense(x)) for m in ensemble.models])))


def simulate(history, future, features, predict):
    """The forecast written as a plain loop over days."""
    state = history.actual_revenue.tolist()[-60:]
    out = []
    for _, day in future.iterrows():
        row = dict(day)
        s = pd.Series(state)
        for n in (1, 7, 14, 30):
            row[f"actual_revenue_lag{n}"] = state[-n] if len(state) >= n else state[-1]
        row["revenue_diff_lag1_lag7"] = row["actual_revenue_lag1"] - row["actual_revenue_lag7"]
        for n in (7, 14, 30):
            row[f"revenue_roll_mean_{n}_lag1"] = s.tail(n).mean()
        row["revenue_roll_std_7_lag1"] = s.tail(7).std()
        for n in (7, 30):
            row[f"revenue_ewma_{n}_lag1"] = s.tail(n).ewm(span=n).mean().iloc[-1]
        for f in features:
            if f not in row:
                row[f] = history[f].iloc[-1]
        value = max(0.0, predict(np.array([row[f] for f in features], dtype=float)))
        state.append(value)
        out.append(value)
    return out


def future_frame(spark, first, n, cpi=None):
    days = pd.date_range(first, periods=n).date
    return forecast.future_days(spark.createDataFrame([(x,) for x in days], "date date"), cpi=cpi)


def test_recursive_forecast_equals_a_plain_loop(spark, ensemble, matrix, features):
    cpi = spark.createDataFrame([(d("2019-01-01"), 150.0)], "month_start date, CPI double")
    future = future_frame(spark, "2019-07-20", 40, cpi)
    got = forecast.recursive_forecast(matrix, future, ensemble).orderBy("date").toPandas()
    expected = simulate(
        matrix.orderBy("date").toPandas(), future.orderBy("date").toPandas(), features, scorer(ensemble)
    )
    assert got.real_revenue.tolist() == pytest.approx(expected, rel=1e-9)
    assert got.revenue.tolist() == pytest.approx([1.5 * v for v in expected], rel=1e-9)


def test_first_day_equals_the_batch_features(spark, ensemble, matrix, features):
    """Hide the last day and forecast it: same features as the matrix, but the short weighted means."""
    last = matrix.agg(F.max("date")).first()[0]
    history = matrix.where(F.col("date") < F.lit(last))
    future = future_frame(spark, str(last), 1)
    got = forecast.recursive_forecast(history, future, ensemble).first().real_revenue
    row = matrix.where(F.col("date") == F.lit(last)).toPandas().iloc[0]
    past = history.orderBy("date").toPandas()
    values = past.actual_revenue
    for n in (7, 30):
        row[f"revenue_ewma_{n}_lag1"] = values.tail(n).ewm(span=n).mean().iloc[-1]
    row["sessions_roll_30_lag1"] = past["sessions_roll_30_lag1"].iloc[-1]
    assert got == pytest.approx(scorer(ensemble)(row[features].to_numpy(dtype=float)), rel=1e-9)


def test_many_series_are_forecast_apart(spark):
    keys = ("store",)
    daily = make_daily(spark, 120, ("a", "b", "c")).drop("sessions")
    matrix = materialise(series.training_matrix(daily, keys=keys))
    features = series.feature_columns(matrix.columns, (*series.NOT_FEATURES, *keys))
    ensemble = model.fit_ensemble(matrix, features, LEARNERS)
    days = spark.createDataFrame([(d("2019-05-01"),), (d("2019-05-02"),), (d("2019-05-03"),)], "date date")
    targets = forecast.targets_per_series(matrix, days, keys)
    assert targets.count() == 9
    together = forecast.recursive_forecast(matrix, forecast.future_days(targets), ensemble, keys)
    assert together.columns == ["store", "date", "real_revenue", "revenue"]
    alone = forecast.recursive_forecast(
        matrix.where("store = 'b'"), forecast.future_days(targets.where("store = 'b'")), ensemble, keys
    )
    assert rows(together.where("store = 'b'")) == rows(alone)
    assert together.count() == 9


def test_series_without_history_or_days(spark, ensemble, matrix):
    """Short and missing histories, a NULL key, days that only some series have, and no days at all."""
    past = matrix.select(F.lit("long").alias("values"), "*")
    short = past.orderBy(F.desc("date")).limit(3)
    history = past.union(short.withColumn("values", F.lit("short"))).union(short.withColumn("values", F.lit(None)))
    days = future_frame(spark, "2019-07-20", 5).crossJoin(
        spark.createDataFrame([("long",), ("short",), (None,), ("none",)], "values string")
    ).where("values <> 'short' OR date < '2019-07-23' OR values IS NULL")
    got = forecast.recursive_forecast(history, days, ensemble, ("values",))
    assert got.columns == ["values", "date", "real_revenue", "revenue"]
    found = got.groupBy("values").agg(F.count("*"), F.count("real_revenue")).collect()
    assert {tuple(r) for r in found} == {("long", 5, 5), ("short", 3, 3), (None, 5, 5), ("none", 5, 0)}
    alone = forecast.recursive_forecast(matrix, future_frame(spark, "2019-07-20", 5), ensemble)
    assert rows(got.where("values = 'long'").drop("values")) == rows(alone)
    assert forecast.recursive_forecast(matrix, days.where("false").drop("values"), ensemble).collect() == []


def test_ten_thousand_series(spark, ensemble, matrix):
    """Equal histories under ten thousand keys have one forecast."""
    many = matrix.orderBy(F.desc("date")).limit(40).crossJoin(spark.range(10_000).withColumnRenamed("id", "key"))
    days = future_frame(spark, "2019-07-20", 3)
    targets = forecast.targets_per_series(many, days, ("key",))
    got = forecast.recursive_forecast(many, forecast.future_days(targets), ensemble, ("key",))
    summed = got.groupBy("date").agg(F.count("*"), F.count_distinct("real_revenue")).orderBy("date").collect()
    assert [tuple(r) for r in summed] == [(d(f"2019-07-{n}"), 10_000, 1) for n in (20, 21, 22)]


def test_merge_keeps_the_samples_cost(spark):
    sample = spark.createDataFrame([(d("2023-01-01"), 0.0, 7.0), (d("2023-01-02"), 0.0, 8.0)],
                                   "Date date, Revenue double, COGS double")
    made = spark.createDataFrame([(d("2023-01-02"), 5.0)], "date date, revenue double")
    assert rows(forecast.merge_submission(sample, made)) == [
        (d("2023-01-01"), None, 7.0), (d("2023-01-02"), 5.0, 8.0)
    ]


def test_registered_queries_use_the_library_defaults(monkeypatch):
    from marketide.plans import registry

    assert registry.QUERY_LEARNERS == (model.SHALLOW, model.DEEP)
    asked = []
    monkeypatch.setattr(registry, "_split_matrix", lambda t: ("train", "test", ["x"]))
    monkeypatch.setattr(registry, "tune", lambda *a: None)
    monkeypatch.setattr(registry.readers, "stored_bytes", lambda *a: 0)
    monkeypatch.setattr(registry.roles, "load_roles", lambda *a: None)
    monkeypatch.setattr(registry.model, "search", lambda *a, **b: asked.append((a, b)))
    monkeypatch.setattr(registry.model, "search_table", lambda *a: type("Nothing", (), {"dtypes": []}))
    registry.REGISTRY["cv_search"](None, "/nowhere")
    assert asked == [(("train", ["x"]), {})]
