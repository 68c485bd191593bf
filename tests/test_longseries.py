"""Windows of long series, in blocks of a few rows, against plain figures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_close, random_series, rows
from marketide.operators import longseries, series


def frame(spark, pdf):
    return spark.createDataFrame(
        [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)],
        "date date, actual_revenue double",
    )


@pytest.mark.parametrize("size", [31, 64, 100_000])
def test_blocks_give_the_columns_of_one_window(spark, size):
    """Two series and one without a key, of other lengths, with missing values."""
    parts = []
    for key, n in (("a", 400), ("b", 95), (None, 65)):
        pdf = random_series(n, seed=n, missing=0.03)
        parts.append(frame(spark, pdf.rename(columns={"v": "actual_revenue"})).withColumn("store", F.lit(key)))
    df = parts[0].union(parts[1]).union(parts[2])
    expected = series.add_revenue_windows(df, partition_by=("store",))
    got = longseries.add_revenue_windows(df, partition_by=("store",), size=size)
    assert set(got.columns) == set(expected.columns)
    order = ["store", "date"]
    one, other = (d.orderBy(*order).select(*expected.columns).toPandas() for d in (got, expected))
    assert len(one) == len(other) == 560
    for c in expected.columns:
        if c in ("store", "date", "actual_revenue"):
            assert one[c].equals(other[c])
        else:
            assert_close(one[c], other[c])


def test_every_block_has_its_rows(spark):
    blocks = longseries.cut(spark.range(1000).withColumn("k", F.col("id") % 3 == 0), ["id"], ["k"], size=50)
    sizes = blocks.rows.groupBy("k", longseries.BLOCK).count().collect()
    assert max(r["count"] for r in sizes) == 50
    assert {(r["k"], sum(x["count"] for x in sizes if x["k"] == r["k"])) for r in sizes} == {(True, 334), (False, 666)}
    order = [r[0] for r in blocks.rows.where("NOT k").orderBy(longseries.POSITION).select("id").collect()]
    assert order == [i for i in range(1000) if i % 3]
    with pytest.raises(ValueError):
        longseries.look_back(blocks, longseries.lag_columns("id", (60,)), 60)


def test_no_task_has_much_more_than_the_mean(spark):
    """One series with all rows: ranges and blocks split it."""
    n, size = 200_000, 5_000
    blocks = longseries.cut(spark.range(n).withColumn("v", F.rand(3)), ["id"], size=size)
    ranges = blocks.rows.groupBy(longseries.BLOCK).count().collect()
    assert {r["count"] for r in ranges} == {size} and len(ranges) == n // size
    out = longseries.look_back(blocks, longseries.lag_columns("id", (1, 30)), 30)
    assert out.where("id_lag30 = id - 30").count() == n - 30


def test_long_span_reaches_over_many_blocks(spark):
    pdf = random_series(300, seed=8, missing=0.1)
    df = frame(spark, pdf.rename(columns={"v": "actual_revenue"}))
    got = longseries.add_ewm(longseries.cut(df, ["date"], size=7), "actual_revenue", 50, "e").rows
    expected = pdf.v.ewm(span=50).mean().shift(1)
    assert_close(got.orderBy("date").toPandas().e, expected)


@pytest.mark.parametrize("size", [4, 1000])
def test_running_total_and_fill(spark, size):
    rng = np.random.default_rng(size)
    pdf = pd.DataFrame({"i": np.arange(60), "v": rng.integers(0, 9, 60).astype(float)})
    pdf.loc[(pdf.i < 11) | rng.integers(0, 2, 60).astype(bool), "v"] = np.nan
    df = spark.createDataFrame([(int(i), None if np.isnan(v) else v) for i, v in zip(pdf.i, pdf.v)], "i int, v double")
    blocks = longseries.cut(df.repartition(5), ["i"], size=size)
    got = longseries.add_filled(longseries.add_running_total(blocks, "v", "total"), "v", "filled").rows.orderBy("i").toPandas()
    assert_close(got.total, pdf.v.fillna(0).cumsum())
    assert_close(got.filled, pdf.v.ffill().bfill())
    empty = longseries.cut(df.where("false"), ["i"], size=size)
    assert longseries.add_filled(longseries.add_running_total(empty, "v", "t"), "v", "f").rows.count() == 0


@pytest.mark.parametrize("size", [3, 1000])
def test_covered_to_the_second_with_open_ends(spark, size):
    t = lambda s: None if s is None else dt.datetime(2024, 3, 1) + dt.timedelta(seconds=s)
    spans = [(10, 20), (15, 18), (20, 20), (40, 39), (50, None), (None, 2), (30, 30)]
    times = [None, 0, 2, 3, 9, 10, 17, 20, 21, 30, 31, 39, 40, 49, 50, 51, 10, 10_000]
    df = spark.createDataFrame([(t(s), s) for s in times], "date timestamp, s int")
    intervals = spark.createDataFrame([(t(a), t(b)) for a, b in spans], "start_date timestamp, end_date timestamp")
    inside = lambda s: s is not None and any((a is None or a <= s) and (b is None or s <= b) for a, b in spans if a is None or b is None or a <= b)
    got = longseries.flag_covered(df, intervals, size=size)
    assert got.columns == ["date", "s", "is_promo_active"]
    assert sorted(map(str, rows(got.select("s", "is_promo_active")))) == sorted(str((s, int(inside(s)))) for s in times)
    assert longseries.flag_covered(df, intervals.where("false")).where("is_promo_active = 1").count() == 0
