"""Queries over the test tables, by name."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketide.operators import (
    encode,
    errors,
    forecast,
    linear,
    longseries,
    model,
    quality,
    questions,
    revenue,
    seasonal,
    series,
    star,
)
from marketide.operators.skew import DEFAULT, Spread, join_spread
from marketide.session import materialise, shared_dir, tune
from marketide.sources import readers, roles, writers

Tables = dict[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Years of the test series: 1995 to 2000 are whole, 2001 ends in August.
FULL_YEARS = (1995, 2000)
BASE_YEAR = 2000
VALIDATION_YEARS = [1999, 2000]

PRODUCT_LABELS = ("category", "segment", "color")
Q3_CATEGORY = "ECONOMY"

# The entries named *_spread take the path of large tables: every key above a thousand rows is dealt out.
FORCED = Spread(above_bytes=0, rows_per_task=1000, broadcast_small=False)

TRANSACTION_TABLES = ("order_items", "orders", "payments", "shipments", "returns", "reviews")


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a builder under its own name. Dates leave as ISO text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark, readers.stored_bytes(spark, f"{sf_dir}/lineitem.parquet"))
        out = build(roles.load_roles(spark, sf_dir))
        dates = {c: F.col(c).cast("string") for c, kind in out.dtypes if kind == "date"}
        return out.withColumns(dates) if dates else out

    REGISTRY[build.__name__] = run
    return build


def _pick(t: Tables, *names: str) -> list[DataFrame]:
    return [t[n] for n in names]


def _labels(df: DataFrame, *columns: str) -> dict[str, list[str]]:
    """The labels that the data have."""
    return {c: encode.labels_of(df, c) for c in columns}


def priced(t: Tables, spread: Spread = DEFAULT) -> DataFrame:
    return series.priced_lines(
        *_pick(t, "order_items", "orders", "returns", "products", "promotions"), spread=spread
    )


def daily(t: Tables) -> DataFrame:
    """The daily series, its sums rounded far below the amounts' own digits, so that figures
    derived from it do not hang on the last digit of a double."""
    return _rounded(series.daily_sales(priced(t)), 6)


def kept_daily(t: Tables) -> DataFrame:
    """The daily series, computed once for plans that read it several times."""
    return materialise(daily(t))


def _fact_sales(t: Tables, spread: Spread = DEFAULT) -> DataFrame:
    fact = star.fact_sales(
        *_pick(t, "order_items", "orders", "payments", "shipments", "returns", "products", "promotions"),
        spread=spread,
    )
    return fact.withColumn("return_quantity", F.col("return_quantity").cast("double"))


# --- star schema and lines -------------------------------------------------------


@query
def dim_product(t: Tables) -> DataFrame:
    return star.dim_product(t["products"])


@query
def dim_customer(t: Tables) -> DataFrame:
    return star.dim_customer(t["customers"], t["geography"])


@query
def fact_sales(t: Tables) -> DataFrame:
    return _fact_sales(t)


@query
def fact_sales_spread(t: Tables) -> DataFrame:
    return _fact_sales(t, FORCED)


@query
def transaction_matrix(t: Tables) -> DataFrame:
    return star.transaction_matrix(*_pick(t, *TRANSACTION_TABLES))


@query
def transaction_matrix_spread(t: Tables) -> DataFrame:
    return star.transaction_matrix(*_pick(t, *TRANSACTION_TABLES), spread=FORCED)


@query
def net_revenue_lines(t: Tables) -> DataFrame:
    return star.net_revenue_lines(*_pick(t, *TRANSACTION_TABLES, "promotions"))


def _transaction_master(t: Tables, spread: Spread = DEFAULT) -> DataFrame:
    customers = encode.encode_customers(t["customers"])
    products = encode.encode_products(t["products"])
    wide = star.with_master_data(*_pick(t, *TRANSACTION_TABLES, "promotions"), products, customers, spread)
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def transaction_master(t: Tables) -> DataFrame:
    return _transaction_master(t)


@query
def transaction_master_spread(t: Tables) -> DataFrame:
    return _transaction_master(t, FORCED)


@query
def publish_star(t: Tables) -> DataFrame:
    """Write the six tables to the shared folder, read them back and profile them."""
    spark = t["orders"].sparkSession
    run = spark.sql("SELECT uuid()").first()[0]
    paths = writers.publish_star(star.star_schema(t), f"{shared_dir(spark)}/star-{run}")
    back = {name: spark.read.parquet(path) for name, path in paths.items()}
    parts = ("part_year", "part_month")
    dates = {"fact_sales": "order_date", "dim_customer": "signup_date",
             "dim_promotion": "start_date", "fact_webtraffic": "date"}
    return quality.table_summary({n: (df.drop(*parts), dates.get(n)) for n, df in back.items()})


# --- daily series ----------------------------------------------------------------


@query
def daily_sales(t: Tables) -> DataFrame:
    return daily(t)


@query
def daily_series(t: Tables) -> DataFrame:
    wide = _rounded(series.daily_series(priced(t), _labels(t["products"], *PRODUCT_LABELS)), 6)
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def daily_series_spread(t: Tables) -> DataFrame:
    wide = _rounded(series.daily_series(priced(t, FORCED), _labels(t["products"], *PRODUCT_LABELS)), 6)
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def daily_sliced_revenue(t: Tables) -> DataFrame:
    wide = _rounded(series.daily_slices(priced(t), _labels(t["products"], *PRODUCT_LABELS)), 6)
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def daily_slices_long(t: Tables) -> DataFrame:
    return _rounded(series.daily_slices_long(priced(t)), 6)


# --- questions -------------------------------------------------------------------


@query
def q1_order_gap(t: Tables) -> DataFrame:
    return questions.q1_order_gap(t["orders"])


@query
def q2_segment_margin(t: Tables) -> DataFrame:
    margins = questions.q2_segment_margin(star.dim_product(t["products"]))
    return questions.top_label(margins, "segment", "gross_margin").withColumn(
        "gross_margin", F.round("gross_margin", 9)
    )


@query
def q2_segment_margin_report(t: Tables) -> DataFrame:
    margins = questions.q2_segment_margin(star.dim_product(t["products"]))
    return margins.orderBy(F.desc("gross_margin")).withColumn(
        "gross_margin", F.round("gross_margin", 9)
    )


@query
def q3_return_reason(t: Tables) -> DataFrame:
    counts = questions.q3_return_reasons(t["returns"], star.dim_product(t["products"]), Q3_CATEGORY)
    return questions.top_label(counts, "return_reason", "n_returns")


@query
def q4_bounce_rate(t: Tables) -> DataFrame:
    rates = questions.q4_bounce_rate(t["web_traffic"])
    return questions.top_label(rates, "traffic_source", "bounce_rate", ascending=True).withColumn(
        "bounce_rate", F.round("bounce_rate", 6)
    )


@query
def q5_promoted_share(t: Tables) -> DataFrame:
    share = questions.q5_promoted_share(t["order_items"])
    return share.select(F.round("promoted_pct", 9).alias("promoted_pct"))


def _dim_customer(t: Tables) -> DataFrame:
    return star.dim_customer(t["customers"], t["geography"])


@query
def q6_age_group_orders(t: Tables) -> DataFrame:
    means = questions.q6_orders_per_age_group(t["orders"], _dim_customer(t))
    return questions.top_label(means, "age_group", "mean_orders").withColumn(
        "mean_orders", F.round("mean_orders", 9)
    )


def _region_revenue(t: Tables) -> DataFrame:
    lines = star.revenue_lines(*_pick(t, "order_items", "orders", "promotions"))
    return _rounded(questions.q7_region_revenue(lines, _dim_customer(t)), 6)


@query
def q7_region_revenue(t: Tables) -> DataFrame:
    return questions.top_label(_region_revenue(t), "region", "actual_revenue")


@query
def q7_region_revenue_report(t: Tables) -> DataFrame:
    return _region_revenue(t)


@query
def q8_cancelled_payment(t: Tables) -> DataFrame:
    return questions.top_label(
        questions.q8_cancelled_payments(t["orders"]), "payment_method", "n_orders"
    )


@query
def q9_size_return_rate(t: Tables) -> DataFrame:
    rates = questions.q9_return_rate(*_pick(t, "order_items", "products", "returns"))
    return questions.top_label(rates, "size", "return_rate").withColumn(
        "return_rate", F.round("return_rate", 9)
    )


@query
def q9_return_rate_report(t: Tables) -> DataFrame:
    rates = questions.q9_return_rate(*_pick(t, "order_items", "products", "returns"))
    return rates.withColumn("return_rate", F.round("return_rate", 9))


@query
def q9_return_rate_lines_once(t: Tables) -> DataFrame:
    rates = questions.q9_return_rate(
        *_pick(t, "order_items", "products", "returns"), repeat_lines=False
    )
    return rates.withColumn("return_rate", F.round("return_rate", 9))


@query
def q10_installments(t: Tables) -> DataFrame:
    means = questions.q10_installments(t["payments"])
    return questions.top_label(means, "installments", "payment_value").withColumn(
        "payment_value", F.round("payment_value", 4)
    )


# --- quality ---------------------------------------------------------------------

RAW_TABLES = ("products", "customers", "geography", "orders", "order_items", "payments",
              "shipments", "returns", "reviews", "promotions", "web_traffic")


@query
def null_profile(t: Tables) -> DataFrame:
    return quality.null_profile({n: t[n] for n in RAW_TABLES})


@query
def duplicate_profile(t: Tables) -> DataFrame:
    return quality.duplicate_profile({n: t[n] for n in RAW_TABLES})


@query
def duplicate_profile_spread(t: Tables) -> DataFrame:
    return quality.duplicate_profile({n: t[n] for n in RAW_TABLES}, FORCED)


def _reconciliation(t: Tables, spread: Spread = DEFAULT) -> DataFrame:
    pair = ["order_id", "product_id"]
    return quality.join_reconciliation(
        t["order_items"],
        [
            ("orders", t["orders"], ["order_id"]),
            ("payments", t["payments"], ["order_id"]),
            ("shipments", t["shipments"], ["order_id"]),
            ("returns", star.returns_by_line(t["returns"]), pair),
            ("single_returns", t["returns"], pair),
            ("reviews", t["reviews"], pair),
            ("promotions", t["promotions"], ["promo_id"]),
        ],
        "order_items",
        spread,
    )


@query
def join_reconciliation(t: Tables) -> DataFrame:
    return _reconciliation(t)


@query
def join_reconciliation_spread(t: Tables) -> DataFrame:
    return _reconciliation(t, FORCED)


PROFILED = {
    "products": PRODUCT_LABELS,
    "customers": ("city", "gender", "age_group", "acquisition_channel"),
    "promotions": ("promo_name", "promo_type", "applicable_category", "promo_channel"),
    "geography": ("city", "region", "district"),
}


def _profiled(t: Tables, profile: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    parts = [
        profile(t[name], list(columns)).select(F.lit(name).alias("table_name"), "*")
        for name, columns in PROFILED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def cardinality_profile(t: Tables) -> DataFrame:
    return _profiled(t, quality.cardinality_profile)


@query
def distinct_values(t: Tables) -> DataFrame:
    return _profiled(t, quality.value_counts)


@query
def frequencies_with_null(t: Tables) -> DataFrame:
    """City, district and all other labels with their counts, NULL as a value."""
    return _profiled(t, lambda df, columns: quality.value_counts(df, columns, dropna=False))


@query
def frequency_with_null(t: Tables) -> DataFrame:
    return quality.frequency_with_null(t["customers"], "age_group")


@query
def table_summary(t: Tables) -> DataFrame:
    return quality.table_summary({
        "orders": (t["orders"], "order_date"),
        "order_items": (t["order_items"], None),
        "shipments": (t["shipments"], "ship_date"),
        "returns": (t["returns"], "return_date"),
        "reviews": (t["reviews"], "review_date"),
        "customers": (t["customers"], "signup_date"),
        "web_traffic": (t["web_traffic"], "date"),
    })


@query
def latest_days(t: Tables) -> DataFrame:
    return quality.preview(daily(t).select("date", "actual_revenue", "quantity"), 5, "date", last=True)


# --- encoders --------------------------------------------------------------------


@query
def ordinal_encode(t: Tables) -> DataFrame:
    return encode.ordinal(t["customers"], "age_group", encode.AGE_CODES, "age_code").select(
        "customer_id", "age_group", "age_code"
    )


@query
def encoded_products(t: Tables) -> DataFrame:
    wide = encode.encode_products(t["products"])
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def encoded_promotions(t: Tables) -> DataFrame:
    """Encoded promotions, with the number of lines that carry each."""
    coded = encode.encode_promotions(t["promotions"])
    used = t["order_items"].groupBy("promo_id").agg(F.count("*").alias("n_lines"))
    return coded.join(used, "promo_id", "left")


@query
def encoded_geography(t: Tables) -> DataFrame:
    return encode.encode_geography(t["geography"])


@query
def rank_encode_city(t: Tables) -> DataFrame:
    return encode.frequency_rank(t["customers"], "city")


@query
def one_hot_sparse(t: Tables) -> DataFrame:
    """Ids of the labels that a customer has; the dictionary itself has no bound."""
    columns = ["gender", "acquisition_channel", "city"]
    dictionary = materialise(encode.label_dictionary(t["customers"], columns))
    found = encode.one_hot_sparse(t["customers"].select("customer_id", *columns), columns, dictionary, spread=FORCED)
    return found.select("customer_id", F.array_join(F.transform("label_ids", lambda x: x.cast("string")), ",").alias("label_ids"))


@query
def daily_sliced_revenue_sparse(t: Tables) -> DataFrame:
    """Maps of revenue per label and day, spread out to the columns of daily_sliced_revenue."""
    labels = _labels(t["products"], *PRODUCT_LABELS)
    dictionary = materialise(encode.label_dictionary(t["products"], PRODUCT_LABELS))
    maps = series.daily_slices_sparse(priced(t), dictionary)
    wide = _rounded(series.revenue_columns(maps, encode.ids_of(dictionary, labels)), 6)
    return wide.toDF(*[c.replace("#", "_") for c in wide.columns])


@query
def one_hot(t: Tables) -> DataFrame:
    coded = encode.encode_customers(t["customers"])
    return coded.drop("zip", "signup_date")


# --- series features -------------------------------------------------------------


@query
def calendar_features(t: Tables) -> DataFrame:
    days = t["orders"].select(F.col("order_date").alias("date")).distinct()
    out = series.with_calendar(days)
    waves = [c for c in out.columns if c.startswith(("sin_", "cos_"))]
    return out.withColumns({c: F.round(c, 9) for c in waves})


@query
def promo_active_days(t: Tables) -> DataFrame:
    return series.flag_intervals(daily(t).select("date"), t["promotions"])


@query
def holiday_flags(t: Tables) -> DataFrame:
    return series.flag_holidays(daily(t).select("date"), t["holidays"])


@query
def cpi_deflate(t: Tables) -> DataFrame:
    real = revenue.deflate(daily(t).select("date", "actual_revenue"), t["cpi"], real="real_revenue")
    return real.drop("actual_revenue")


@query
def inflation_lookup(t: Tables) -> DataFrame:
    days = daily(t).select("date", "actual_revenue")
    nominal = revenue.index_of_day(days, t["cpi"])
    return nominal.select(
        "date", "inflation_factor",
        (F.col("actual_revenue") * F.col("inflation_factor")).alias("nominal_revenue"),
    )


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Figures that depend on the order of additions, rounded; all doubles by default."""
    chosen = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in chosen})


@query
def lag_features(t: Tables) -> DataFrame:
    out = series.add_lags(daily(t).select("date", "actual_revenue"), "actual_revenue")
    return out.withColumn(
        "revenue_diff_lag1_lag7", F.col("actual_revenue_lag1") - F.col("actual_revenue_lag7")
    )


@query
def rolling_features(t: Tables) -> DataFrame:
    out = daily(t).select("date", "actual_revenue").withColumns({
        "roll_mean_7": series.rolling("actual_revenue", 7),
        "roll_mean_14": series.rolling("actual_revenue", 14),
        "roll_mean_30": series.rolling("actual_revenue", 30),
        "roll_std_7": series.rolling("actual_revenue", 7, "std"),
    })
    return _rounded(out, 2, "roll_std_7")


@query
def ewma_features(t: Tables) -> DataFrame:
    out = daily(t).select("date", "actual_revenue")
    for span in series.EWM_SPANS:
        out = series.add_ewm(out, "actual_revenue", span, f"ewma_{span}")
    return _rounded(out, 2, "ewma_7", "ewma_30")


# Blocks of a few rows stand for long series here, so that every series has many of them.
FEW_ROWS = 64


@query
def lag_features_blocks(t: Tables) -> DataFrame:
    blocks = longseries.cut(kept_daily(t).select("date", "actual_revenue"), ["date"], size=FEW_ROWS)
    out = longseries.look_back(blocks, longseries.lag_columns("actual_revenue"), max(series.LAGS))
    difference = F.col("actual_revenue_lag1") - F.col("actual_revenue_lag7")
    return out.withColumn("revenue_diff_lag1_lag7", difference).drop(longseries.BLOCK, longseries.POSITION)


@query
def rolling_features_blocks(t: Tables) -> DataFrame:
    blocks = longseries.cut(kept_daily(t).select("date", "actual_revenue"), ["date"], size=FEW_ROWS)
    out = longseries.look_back(blocks, longseries.rolling_columns("actual_revenue"), max(series.ROLLING_MEANS))
    return _rounded(out, 2, "roll_std_7").drop(longseries.BLOCK, longseries.POSITION)


@query
def ewma_features_blocks(t: Tables) -> DataFrame:
    blocks = longseries.cut(kept_daily(t).select("date", "actual_revenue"), ["date"], size=FEW_ROWS)
    for span in series.EWM_SPANS:
        blocks = longseries.add_ewm(blocks, "actual_revenue", span, f"ewma_{span}")
    return _rounded(blocks.rows, 2, "ewma_7", "ewma_30").drop(longseries.BLOCK, longseries.POSITION)


@query
def promo_active_days_sweep(t: Tables) -> DataFrame:
    return longseries.flag_covered(kept_daily(t).select("date"), t["promotions"], size=FEW_ROWS)


@query
def line_windows(t: Tables) -> DataFrame:
    """All order lines as one series, in the order of order and product: lag, rolling mean and running quantity."""
    lines = t["order_items"].groupBy("order_id", "product_id").agg(F.sum("quantity").cast("long").alias("quantity"))
    blocks = longseries.cut(materialise(lines), ["order_id", "product_id"], size=10_000)
    blocks = longseries.add_running_total(blocks, "quantity", "running_quantity")
    out = longseries.look_back(
        blocks,
        lambda order, by: longseries.lag_columns("quantity", (1, 30))(order, by)
        | {"mean_7": series.rolling("quantity", 7, "mean", order, by)},
        30,
    )
    return out.drop(longseries.BLOCK, longseries.POSITION)


def _regional_lines(t: Tables) -> DataFrame:
    """Lines with the region of their order's customer, which is joined to the orders."""
    regions = _dim_customer(t).select("customer_id", "region")
    located = join_spread(t["orders"], regions, ["customer_id"], "left")
    return series.priced_lines(
        t["order_items"], located, *_pick(t, "returns", "products", "promotions"), keys=("region",)
    )


@query
def regional_series(t: Tables) -> DataFrame:
    """The window features over five series side by side."""
    by_region = _rounded(series.daily_sales(_regional_lines(t), ("region",)), 6).select(
        "region", "date", "actual_revenue"
    )
    out = series.add_lags(by_region, "actual_revenue", (1, 7), "date", ("region",))
    out = out.withColumn(
        "roll_mean_7", series.rolling("actual_revenue", 7, "mean", "date", ("region",))
    )
    out = series.add_ewm(out, "actual_revenue", 7, "ewma_7", "date", ("region",))
    return _rounded(out, 2, "ewma_7")


@query
def traffic_rolling(t: Tables) -> DataFrame:
    rolled = series.traffic_features(t["daily_sessions"])
    last = series.traffic_features(t["daily_sessions"], window=None)
    return rolled.join(last, "date").withColumn("sessions_lag1", F.col("sessions_lag1").cast("double"))


def _matrix(t: Tables) -> DataFrame:
    return series.training_matrix(
        daily(t), t["promotions"], t["cpi"], t["holidays"], t["daily_sessions"]
    )


@query
def training_matrix(t: Tables) -> DataFrame:
    out = _matrix(t)
    waves = [c for c in out.columns if c.startswith(("sin_", "cos_"))]
    weighted = [c for c in out.columns if "_std_" in c or "_ewma_" in c]
    return _rounded(_rounded(out, 9, *waves), 2, *weighted)


@query
def training_matrix_v1(t: Tables) -> DataFrame:
    labels = {"category": ["ECONOMY", "LARGE"], "color": ["red"]}
    with_slices = _rounded(series.daily_series(priced(t), labels), 6)
    columns = tuple(f"revenue_{c}_{label}" for c, values in labels.items() for label in values)
    matrix = series.early_training_matrix(with_slices, t["daily_sessions"], label_columns=columns)
    return _rounded(matrix, 2, "revenue_roll_std_7_lag1")


@query
def chrono_split(t: Tables) -> DataFrame:
    return series.chrono_split(daily(t).select("date"))


@query
def expanding_folds(t: Tables) -> DataFrame:
    return series.expanding_folds(daily(t).select("date"))


@query
def last_n(t: Tables) -> DataFrame:
    return series.last_rows(daily(t).select("date", "actual_revenue"), 60)


# --- seasonal forecast -----------------------------------------------------------


def _sales(t: Tables) -> DataFrame:
    return seasonal.as_sales(kept_daily(t))


@query
def yoy_growth(t: Tables) -> DataFrame:
    sales = seasonal.as_sales(daily(t))
    return _rounded(seasonal.yoy_growth(seasonal.annual_totals(sales), *FULL_YEARS), 9)


@query
def mean_growth(t: Tables) -> DataFrame:
    sales = seasonal.as_sales(daily(t))
    return _rounded(seasonal.mean_growth(seasonal.annual_totals(sales), *FULL_YEARS), 9)


@query
def seasonal_profile(t: Tables) -> DataFrame:
    return _rounded(seasonal.seasonal_profile(seasonal.as_sales(daily(t))), 9)


@query
def seasonal_forecast(t: Tables) -> DataFrame:
    sales = _sales(t)
    horizon = sales.where(F.year("date") > BASE_YEAR).select("date")
    forecast = seasonal.seasonal_forecast(sales, horizon, BASE_YEAR, *FULL_YEARS, digits=None)
    return _rounded(forecast, 4)


@query
def seasonal_validation(t: Tables) -> DataFrame:
    return _rounded(
        seasonal.seasonal_validation(_sales(t), VALIDATION_YEARS, BASE_YEAR, *FULL_YEARS), 6
    )


@query
def submission_export(t: Tables) -> DataFrame:
    sales = _sales(t)
    horizon = sales.where(F.year("date") > BASE_YEAR).select("date")
    return seasonal.submission(
        seasonal.seasonal_forecast(sales, horizon, BASE_YEAR, *FULL_YEARS)
    )


# --- errors ----------------------------------------------------------------------


def _naive(t: Tables) -> DataFrame:
    return errors.naive_forecast(daily(t))


@query
def naive_lag7_errors(t: Tables) -> DataFrame:
    return _naive(t)


@query
def error_summary(t: Tables) -> DataFrame:
    return _rounded(errors.error_summary(_naive(t)), 4)


@query
def error_metrics(t: Tables) -> DataFrame:
    return _rounded(errors.metrics(_naive(t)), 4)


@query
def monthly_error_profile(t: Tables) -> DataFrame:
    return _rounded(errors.monthly_errors(_naive(t)), 4)


@query
def extreme_months(t: Tables) -> DataFrame:
    return _rounded(errors.extreme_months(_naive(t)), 4)


@query
def worst_best_days(t: Tables) -> DataFrame:
    return errors.extreme_days(_naive(t))


CORRELATED = ["actual_revenue_lag1", "actual_revenue_lag7", "revenue_roll_mean_7_lag1",
              "revenue_roll_std_7_lag1", "revenue_ewma_7_lag1", "revenue_ewma_30_lag1",
              "month", "dayofweek", "is_holiday", "is_promo_active"]


@query
def feature_correlation(t: Tables) -> DataFrame:
    return _rounded(errors.correlations(_matrix(t), "actual_revenue", CORRELATED), 8)


@query
def error_correlation(t: Tables) -> DataFrame:
    matrix = _matrix(t).withColumn(
        "abs_error", F.abs(F.col("actual_revenue") - F.col("actual_revenue_lag7"))
    )
    return _rounded(errors.correlations(matrix, "abs_error", CORRELATED), 8)


@query
def scaled_features(t: Tables) -> DataFrame:
    columns = ["quantity", "customer_id", "is_returned"]
    scaled = encode.scaled(kept_daily(t).select("date", *columns), columns)
    values = vector_to_array("features")
    return scaled.select(
        "date", *[F.round(values[i], 9).alias(f"{c}_scaled") for i, c in enumerate(columns)]
    )


# --- models ----------------------------------------------------------------------

QUERY_LEARNERS = (model.SHALLOW, model.DEEP)


def _split_matrix(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training part, last fifth, feature names."""
    split = series.chrono_split(materialise(_matrix(t)))
    train = split.where("is_train = 1").drop("is_train")
    test = split.where("is_train = 0").drop("is_train")
    return train, test, series.feature_columns(train.columns)


@query
def gbt_ensemble_metrics(t: Tables) -> DataFrame:
    train, test, features = _split_matrix(t)
    return model.evaluate(model.fit_ensemble(train, features, QUERY_LEARNERS), test)


@query
def gbt_errors(t: Tables) -> DataFrame:
    train, test, features = _split_matrix(t)
    ensemble = model.fit_ensemble(train, features, QUERY_LEARNERS)
    return errors.extreme_days(model.model_errors(ensemble, test))


@query
def gbt_importance(t: Tables) -> DataFrame:
    train, _, features = _split_matrix(t)
    return model.importance(model.fit_ensemble(train, features, QUERY_LEARNERS), train)


@query
def permutation_importance(t: Tables) -> DataFrame:
    train, test, features = _split_matrix(t)
    return model.permutation_importance(model.fit_ensemble(train, features, QUERY_LEARNERS), test)


@query
def scaled_pipeline_r2(t: Tables) -> DataFrame:
    train, test, features = _split_matrix(t)
    r2 = model.scaled_pipeline_r2(train, test, features, QUERY_LEARNERS[1])
    return test.agg(F.count("*").alias("n"), F.lit(r2).alias("r2"))


@query
def cv_search(t: Tables) -> DataFrame:
    train, _, features = _split_matrix(t)
    results = model.search(train, features)
    return model.search_table(train, results)


def _horizon(t: Tables) -> DataFrame:
    """The days of the last, incomplete year."""
    return t["orders"].where(F.col("order_date") >= F.lit(dt.date(BASE_YEAR + 1, 1, 1))).select(
        F.col("order_date").alias("date")
    ).distinct()


def _history(matrix: DataFrame) -> DataFrame:
    return matrix.where(F.year("date") <= BASE_YEAR)


@query
def recursive_forecast(t: Tables) -> DataFrame:
    history = _history(materialise(_matrix(t)))
    ensemble = model.fit_ensemble(history, series.feature_columns(history.columns), QUERY_LEARNERS)
    days = forecast.future_days(_horizon(t), t["holidays"], t["promotions"], t["cpi"])
    return forecast.recursive_forecast(history, days, ensemble)


@query
def regional_forecast(t: Tables) -> DataFrame:
    """One model over all regions, five series forecast side by side."""
    keys = ("region",)
    lines = _regional_lines(t).where(F.col("region").isNotNull())
    by_region = _rounded(series.daily_sales(lines, keys), 6)
    matrix = series.training_matrix(
        by_region, t["promotions"], t["cpi"], t["holidays"], t["daily_sessions"], keys
    )
    history = _history(materialise(matrix))
    features = series.feature_columns(history.columns, (*series.NOT_FEATURES, *keys))
    ensemble = model.fit_ensemble(history, features, QUERY_LEARNERS)
    targets = forecast.targets_per_series(history, _horizon(t), keys)
    days = forecast.future_days(targets, t["holidays"], t["promotions"], t["cpi"])
    return forecast.recursive_forecast(history, days, ensemble, keys)


@query
def recursive_forecast_linear(t: Tables) -> DataFrame:
    history = _history(kept_daily(t).select("date", "actual_revenue"))
    return _rounded(linear.forecast_lags(history, _horizon(t), "actual_revenue"), 2)


@query
def regional_forecast_linear(t: Tables) -> DataFrame:
    keys = ("region",)
    lines = _regional_lines(t).where(F.col("region").isNotNull())
    by_region = materialise(_rounded(series.daily_sales(lines, keys), 6).select("region", "date", "actual_revenue"))
    history = _history(by_region)
    days = by_region.where(F.year("date") > BASE_YEAR).select("region", "date")
    return _rounded(linear.forecast_lags(history, days, "actual_revenue", "date", keys), 2)


def _through_csv(t: Tables, name: str) -> DataFrame:
    """A table written as CSV with a byte-order mark to the shared folder, and read again by its schema."""
    spark = t[name].sparkSession
    root = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    writers.write_csv(t[name], f"{root}/{name}.csv", bom=True)
    return readers.read_table(spark, root, name)


@query
def csv_orders(t: Tables) -> DataFrame:
    return _through_csv(t, "orders")


@query
def csv_customers(t: Tables) -> DataFrame:
    return _through_csv(t, "customers")


@query
def csv_order_items(t: Tables) -> DataFrame:
    return _through_csv(t, "order_items")


@query
def submission_merge(t: Tables) -> DataFrame:
    sales = _sales(t)
    sample = sales.where(F.year("date") > BASE_YEAR).withColumnRenamed("date", "Date")
    days = sample.select(F.col("Date").alias("date"))
    predicted = seasonal.seasonal_forecast(sales, days, BASE_YEAR, *FULL_YEARS, digits=None)
    merged = forecast.merge_submission(
        sample, predicted.select("date", F.col("Revenue_pred").alias("revenue"))
    )
    return _rounded(merged, 4, "Revenue")
