"""Seasonal forecast and error reports."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import d, rows
from marketide.functions.metrics import error_metrics, mape
from marketide.operators import errors, seasonal


@pytest.fixture(scope="module")
def history():
    rng = np.random.default_rng(4)
    days = pd.date_range("2017-01-01", "2020-12-31")
    days = days[~((days.month == 2) & (days.day == 29) & (days.year == 2020))]
    frame = pd.DataFrame({"date": days, "Revenue": rng.gamma(3, 1000, len(days))})
    frame["COGS"] = frame.Revenue * rng.uniform(0.5, 0.9, len(days))
    return frame


@pytest.fixture(scope="module")
def sales(spark, history):
    return spark.createDataFrame(history).withColumn("date", F.to_date("date"))


def expected_forecast(history, days, base_year, first, last):
    frame = history.assign(year=history.date.dt.year, month=history.date.dt.month, day=history.date.dt.day)
    annual = frame.groupby("year")[["Revenue", "COGS"]].sum()
    change = annual.loc[first:last].pct_change().dropna()
    growth = (1 + change).prod() ** (1 / len(change))
    norm = frame[["Revenue", "COGS"]] / frame.groupby("year")[["Revenue", "COGS"]].transform("mean")
    profile = norm.groupby([frame.month, frame.day]).mean()
    out = []
    for day in days:
        factor = profile.loc[(day.month, day.day)] if (day.month, day.day) in profile.index else 1.0
        out.append(annual.loc[base_year] / 365 * growth ** (day.year - base_year) * factor)
    return pd.DataFrame(out, index=days)


def test_seasonal_forecast_equals_pandas(spark, history, sales):
    days = pd.date_range("2021-12-01", "2024-03-05", freq="5D").union(pd.DatetimeIndex(["2024-02-29"]))
    asked = spark.createDataFrame([(x.date(),) for x in days], "date date")
    got = seasonal.seasonal_forecast(sales, asked, 2020, 2017, 2020, digits=None).orderBy("date").toPandas()
    expected = expected_forecast(history, days, 2020, 2017, 2020)
    assert len(got) == len(days)
    assert got.Revenue_pred.tolist() == pytest.approx(expected.Revenue.tolist(), rel=1e-9)
    assert got.COGS_pred.tolist() == pytest.approx(expected.COGS.tolist(), rel=1e-9)
    rounded = seasonal.seasonal_forecast(sales, asked, 2020, 2017, 2020).orderBy("date").toPandas()
    assert np.abs(rounded.Revenue_pred - got.Revenue_pred).max() <= 0.005 + 1e-9


def test_leap_day_without_history_has_factor_one(spark, sales):
    asked = spark.createDataFrame([(d("2024-02-29"),)], "date date")
    got = seasonal.seasonal_forecast(sales, asked, 2020, 2020, 2020, digits=None).first()
    base = sales.where("year(date) = 2020").agg(F.sum("Revenue")).first()[0] / 365
    assert got.Revenue_pred is None or got.Revenue_pred == pytest.approx(base)   # no growth from one year
    grown = seasonal.seasonal_forecast(sales, asked, 2020, 2017, 2020, digits=None).first()
    growth = seasonal.mean_growth(seasonal.annual_totals(sales), 2017, 2020).first().growth_rev
    assert grown.Revenue_pred == pytest.approx(base * growth**4)


def test_validation_and_submission(spark, history, sales):
    got = seasonal.seasonal_validation(sales, [2019, 2020], 2020, 2017, 2020).first()
    past = history[history.date.dt.year >= 2019]
    expected = expected_forecast(history, past.date, 2020, 2017, 2020)
    share = (np.abs(past.Revenue.to_numpy() - expected.Revenue.to_numpy()) / past.Revenue.to_numpy()).mean()
    assert got.mape_rev == pytest.approx(share * 100, rel=1e-9)
    asked = spark.createDataFrame([(d("2021-01-05"),)], "date date")
    out = seasonal.submission(seasonal.seasonal_forecast(sales, asked, 2020, 2017, 2020))
    assert out.columns == ["Date", "Revenue", "COGS"] and out.first().Date == "2021-01-05"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({
        "date": pd.date_range("2020-01-01", periods=200), "actual": rng.gamma(2, 100, 200),
    })
    frame["pred"] = frame.actual + rng.normal(0, 20, 200)
    frame["abs_error"] = (frame.actual - frame.pred).abs()
    return frame, spark.createDataFrame(frame).withColumn("date", F.to_date("date"))


def test_metrics(table):
    frame, df = table
    got = errors.metrics(df).first()
    error = frame.actual - frame.pred
    assert got.mae == pytest.approx(error.abs().mean())
    assert got.rmse == pytest.approx(np.sqrt((error**2).mean()))
    total = ((frame.actual - frame.actual.mean()) ** 2).sum()
    assert got.r2 == pytest.approx(1 - (error**2).sum() / total)
    assert got.mape == pytest.approx((error.abs() / frame.actual).mean() * 100)
    summary = errors.error_summary(df).first()
    assert summary.std_error == pytest.approx(error.abs().std())
    assert (summary.min_error, summary.max_error) == (error.abs().min(), error.abs().max())


def test_mape_with_zero_actual(spark):
    def one(rows_):
        df = spark.createDataFrame(rows_, "a double, p double")
        return df.agg(mape(F.col("a"), F.col("p"))).first()[0]

    assert one([(0.0, 1.0), (2.0, 1.0)]) == float("inf")
    assert one([(0.0, 0.0), (2.0, 1.0)]) == 50.0


def test_r2_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (None, 5.0), (9.0, None)], "a double, p double")
    got = df.agg(*error_metrics(F.col("a"), F.col("p"))).first()
    assert (got.n, got.r2) == (2, pytest.approx(0.5))


def test_monthly_and_extremes(table):
    frame, df = table
    monthly = frame.groupby(frame.date.dt.month).abs_error.mean()
    assert {r.month: r.mae for r in errors.monthly_errors(df).collect()} == pytest.approx(monthly.to_dict())
    months = {r.kind: r.month for r in errors.extreme_months(df).collect()}
    assert months == {"worst": monthly.idxmax(), "best": monthly.idxmin()}
    days = errors.extreme_days(df, 3)
    worst = sorted(r.abs_error for r in days.where("kind = 'worst'").collect())
    assert worst == sorted(frame.abs_error.nlargest(3))
    best = sorted(r.abs_error for r in days.where("kind = 'best'").collect())
    assert best == sorted(frame.abs_error.nsmallest(3))


def test_naive_forecast_counts_rows_not_days(spark):
    days = [d("2020-01-01"), d("2020-01-05"), d("2020-02-01")]
    df = spark.createDataFrame([(x, float(i)) for i, x in enumerate(days)], "date date, actual_revenue double")
    assert rows(errors.naive_forecast(df, lag=2)) == [(days[2], 2.0, 0.0, 2.0)]


def test_correlations(table):
    frame, df = table
    wide = df.withColumn("flat", F.lit(1.0)).withColumn("minus", -F.col("actual"))
    got = {r.feature: r.correlation_score for r in
           errors.correlations(wide, "actual", ["pred", "minus", "flat"]).collect()}
    assert got["pred"] == pytest.approx(abs(np.corrcoef(frame.pred, frame.actual)[0, 1]))
    assert got["minus"] == pytest.approx(1.0)
    assert got["flat"] is None
