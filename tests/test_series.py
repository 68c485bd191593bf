import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import assert_close, d, random_series
from marketide.operators import series


def frame(spark, pdf):
    """A pandas series frame as a Spark one, in scrambled order, NaN as NULL."""
    data = [
        tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r)
        for r in pdf.sample(frac=1.0, random_state=0).itertuples(index=False)
    ]
    kinds = {"date": "date", "v": "double", "key": "string", "sessions": "long"}
    return spark.createDataFrame(data, ", ".join(f"{c} {kinds[c]}" for c in pdf.columns)).repartition(3)


def ordered(df, column, key=None):
    out = df.where(F.col("key") == key) if key else df
    return [r[0] for r in out.orderBy("date").select(column).collect()]


@pytest.mark.parametrize("missing, skip", [(0.0, 0.0), (0.1, 0.2)])
def test_windows_equal_pandas(spark, missing, skip):
    pdf = random_series(260, missing=missing, skip=skip)
    df = series.add_lags(frame(spark, pdf), "v")
    df = df.withColumns({
        "m7": series.rolling("v", 7), "m30": series.rolling("v", 30), "s7": series.rolling("v", 7, "std"),
    })
    for span in (7, 30):
        df = series.add_ewm(df, "v", span, f"e{span}")
    got = df.orderBy("date").toPandas()
    before = pdf.v.shift(1)
    for n in series.LAGS:
        assert_close(got[f"v_lag{n}"], pdf.v.shift(n))
    assert_close(got.m7, before.rolling(7).mean())
    assert_close(got.m30, before.rolling(30).mean())
    assert_close(got.s7, before.rolling(7).std())
    assert_close(got.e7, before.ewm(span=7).mean())
    assert_close(got.e30, before.ewm(span=30).mean())


def test_weighted_mean_over_many_blocks(spark):
    """Long enough that plain running sums would overflow, and for every span several blocks."""
    pdf = random_series(3000, seed=5, missing=0.05)
    df = frame(spark, pdf)
    for span in (1.5, 3, 7):
        df = series.add_ewm(df, "v", span, f"e{str(span).replace('.', '_')}")
    got = df.orderBy("date").toPandas()
    before = pdf.v.shift(1)
    for span in (1.5, 3, 7):
        assert_close(got[f"e{str(span).replace('.', '_')}"], before.ewm(span=span).mean())


def test_series_side_by_side(spark):
    parts = [random_series(40, seed=s).assign(key=f"k{s}") for s in (1, 2, 3)]
    df = frame(spark, pd.concat(parts, ignore_index=True))
    df = series.add_lags(df, "v", (1,), "date", ("key",)).withColumn(
        "m7", series.rolling("v", 7, "mean", "date", ("key",))
    )
    df = series.add_ewm(df, "v", 7, "e7", "date", ("key",))
    df = series.chrono_split(series.expanding_folds(df, 3, "date", ("key",)), 0.8, "date", ("key",))
    for pdf in parts:
        key = pdf.key[0]
        assert_close(ordered(df, "v_lag1", key), pdf.v.shift(1))
        assert_close(ordered(df, "m7", key), pdf.v.shift(1).rolling(7).mean())
        assert_close(ordered(df, "e7", key), pdf.v.shift(1).ewm(span=7).mean())
        assert ordered(df, "is_train", key) == [1] * 32 + [0] * 8
        assert ordered(df, "fold", key) == [0] * 10 + [1] * 10 + [2] * 10 + [3] * 10


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=5, max_value=60))
def test_splits_equal_their_definition(spark, n):
    pdf = random_series(n)
    df = series.chrono_split(series.expanding_folds(frame(spark, pdf)))
    cut, size = int(0.8 * n), n // 4
    assert ordered(df, "is_train") == [1] * cut + [0] * (n - cut)
    first = n - 3 * size
    assert ordered(df, "fold") == [0] * first + [1] * size + [2] * size + [3] * size


def test_last_rows(spark):
    pdf = random_series(20, skip=0.3)
    got = series.last_rows(frame(spark, pdf), 5).select("date")
    assert sorted(r[0] for r in got.collect()) == list(pdf.date[-5:])


def test_calendar_edges(spark):
    days = [d("2021-01-03"), d("2020-12-31"), d("2021-01-04"), d("2020-02-29"), d("2016-01-02")]
    df = series.with_calendar(spark.createDataFrame([(x,) for x in days], "date date"))
    got = {r.date: r for r in df.collect()}
    for day in days:
        r, stamp = got[day], pd.Timestamp(day)
        assert (r.year, r.month, r.day) == (day.year, day.month, day.day)
        assert (r.dayofweek, r.is_weekend) == (stamp.dayofweek, int(stamp.dayofweek >= 5))
        assert (r.quarter, r.dayofyear, r.week) == (stamp.quarter, stamp.dayofyear, stamp.isocalendar()[1])
        assert r.sin_year_2 == pytest.approx(np.sin(4 * np.pi * stamp.dayofyear / 365.25), abs=1e-12)
        assert r.cos_year_1 == pytest.approx(np.cos(2 * np.pi * stamp.dayofyear / 365.25), abs=1e-12)


def test_flags(spark):
    days = spark.createDataFrame([(d(f"2020-01-{i:02d}"),) for i in range(1, 11)], "date date")
    promos = spark.createDataFrame(
        [(d("2020-01-02"), d("2020-01-03")), (d("2020-01-03"), d("2020-01-05")),
         (d("2020-01-09"), d("2020-01-07")), (None, d("2020-01-10"))],
        "start_date date, end_date date",
    )
    flagged = series.flag_intervals(days, promos)
    assert [r.is_promo_active for r in flagged.orderBy("date").collect()] == [0, 1, 1, 1, 1, 0, 0, 0, 0, 0]
    assert flagged.count() == 10
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    holidays = spark.createDataFrame([(d("2020-01-01"),), (d("2020-01-01"),)], "date date")
    assert sum(r.is_holiday for r in series.flag_holidays(days, holidays).collect()) == 1
    assert {r.is_holiday for r in series.flag_holidays(days, None).collect()} == {0}
    assert {r.is_promo_active for r in series.flag_intervals(days, None).collect()} == {0}


def test_traffic_adds_up_a_day_before_rolling(spark):
    pdf = pd.DataFrame({"date": random_series(40).date, "sessions": range(40)})
    twice = pd.concat([pdf, pdf], ignore_index=True)
    got = series.traffic_features(frame(spark, twice)).orderBy("date").toPandas()
    assert len(got) == 40
    assert_close(got.sessions_roll_30_lag1, (2 * pdf.sessions).shift(1).rolling(30).mean())


def daily(spark, n=60):
    rng = np.random.default_rng(2)
    data = [
        (x, float(v), float(v / 2), 3, 5, 2, 0, float(v / 3))
        for x, v in zip(random_series(n).date, rng.gamma(2, 1000, n))
    ]
    return spark.createDataFrame(
        data, "date date, actual_revenue double, gross_profit double, order_id long, quantity long, "
        "customer_id long, is_returned long, revenue_category_Casual double",
    )


def test_training_matrix_columns_and_rows(spark):
    table = daily(spark)
    matrix = series.training_matrix(table)
    features = series.feature_columns(matrix.columns)
    assert len(features) == 25 and not set(features) & set(series.LEAKY_COLUMNS)
    assert matrix.count() == 30                      # the first thirty rows lack a lag
    assert {r.CPI for r in matrix.select("CPI").collect()} == {100.0}
    traffic = table.select("date", F.col("quantity").alias("sessions"))
    assert len(series.feature_columns(series.training_matrix(table, traffic=traffic).columns)) == 26


def test_a_null_in_a_leaky_column_removes_the_row(spark):
    hole = d("2015-02-20")
    table = daily(spark).withColumn(
        "gross_profit", F.when(F.col("date") != F.lit(hole), F.col("gross_profit"))
    )
    days = [r.date for r in series.training_matrix(table).select("date").collect()]
    assert len(days) == 29 and hole not in days


def test_early_matrix_keeps_lags_of_leaky_columns(spark):
    matrix = series.early_training_matrix(daily(spark))
    assert {"gross_profit_lag1", "order_id_lag7", "actual_revenue_lag1"} <= set(matrix.columns)
    assert not any("revenue_category_" in c for c in matrix.columns)   # removed by part of the name
    assert not {"gross_profit", "dayofyear", "sin_year_1"} & set(matrix.columns)
    assert matrix.count() == 53


def test_price_index_enters_the_matrix(spark):
    cpi = spark.createDataFrame([(d("2015-01-01"), 50.0)], "month_start date, CPI double")
    table = daily(spark)
    plain = {r.date: r for r in series.training_matrix(table).collect()}
    real = {r.date: r for r in series.training_matrix(table, cpi=cpi).collect()}
    for day, r in real.items():
        assert r.actual_revenue == pytest.approx(2 * plain[day].actual_revenue)
        assert r.revenue_ewma_30_lag1 == pytest.approx(2 * plain[day].revenue_ewma_30_lag1)

