"""The recursive linear forecast against a plain loop."""

import datetime as dt

import numpy as np
import pytest

from helpers import d, random_series
from marketide.operators import encode, linear


def plain(values, horizon):
    """Least squares on lags 1 and 7, then one day after the other."""
    y, x, z = values[7:], values[6:-1], values[:-7]
    start, short, long = np.linalg.lstsq(np.stack([np.ones(len(y)), x, z], axis=1), y, rcond=None)[0]
    known = list(values)
    for _ in range(horizon):
        known.append(max(0.0, start + short * known[-1] + long * known[-7]))
    return known[len(values):]


def test_many_series_side_by_side(spark):
    rows, expected = [], {}
    days = [d("2016-01-01") + dt.timedelta(days=i) for i in range(40)]
    for k in range(30):
        values = random_series(120, seed=k)
        rows += [(f"s{k}", r.date, float(r.v)) for r in values.itertuples()]
        for day, v in zip(days, plain(values["v"].to_numpy(), 40)):
            expected[f"s{k}", day] = v
    history = spark.createDataFrame(rows, "k string, date date, v double").repartition(5)
    targets = spark.createDataFrame([(f"s{k}", day) for k in range(30) for day in days], "k string, date date")
    got = {(r.k, r.date): r.forecast for r in linear.forecast_lags(history, targets, "v", "date", ("k",)).collect()}
    assert got.keys() == expected.keys()
    assert all(got[i] == pytest.approx(v, rel=1e-6) for i, v in expected.items())
    one = linear.forecast_lags(
        history.where("k = 's3'").drop("k"), targets.where("k = 's3'").select("date"), "v"
    ).collect()
    assert {r.date: r.forecast for r in one} == pytest.approx({day: expected["s3", day] for day in days})


def test_short_flat_and_missing_series(spark):
    day = lambda i: d("2020-01-01") + dt.timedelta(days=i)
    rows = [("flat", day(i), 5.0) for i in range(30)] + [("short", day(i), float(i)) for i in range(5)]
    history = spark.createDataFrame(rows, "k string, date date, v double")
    targets = spark.createDataFrame([(k, day(50 + i)) for k in ("flat", "short", "none") for i in range(3)], "k string, date date")
    got = linear.forecast_lags(history, targets, "v", "date", ("k",)).collect()
    assert len(got) == 9 and all(r.forecast is None for r in got)
    assert linear.forecast_lags(history, targets.limit(0), "v", "date", ("k",)).count() == 0


def test_labels_come_from_the_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, "never listed"), (3, None)], "id int, k string")
    assert encode.labels_of(df, "k") == ["a", "never listed"]
    assert encode.one_hot(df, ["k"]).columns == ["id", "k_a", "k_never listed"]
