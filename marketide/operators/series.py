"""Daily series: roll-up, calendar, flags, lags, rolling and weighted means, splits.

A series frame has one row per day and series key. Row order only ever comes from
``order_by`` inside a window, and windows hold one series each: its length is bounded
by the calendar, and ``partition_by`` lets any number of series run side by side.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.functions.scalars import (
    calendar_columns,
    harmonic_columns,
    MONEY_PARTS,
    part_sums,
    sum_or_zero,
    whole_sum,
)
from marketide.operators.revenue import (
    attach_promotions,
    deflate,
    gross_profit,
    order_totals,
    with_net_revenue,
)
from marketide.operators.skew import DEFAULT, Spread, attach_to_lines, join_spread
from marketide.operators.star import returns_by_line

# The feature set of the training matrix.
LAGS = (1, 7, 14, 30)
ROLLING_MEANS = (7, 14, 30)
ROLLING_STDS = (7,)
EWM_SPANS = (7, 30)
TRAFFIC_WINDOW = 30
EARLY_LAGS = (1, 7)
EARLY_LAG_COLUMNS = ("actual_revenue", "gross_profit", "order_id", "quantity", "customer_id", "is_returned")
LEAKY_COLUMNS = ("gross_profit", "order_id", "quantity", "customer_id", "is_returned")
LEAKY_PARTS = ("revenue_category_", "revenue_segment", "revenue_color_")
NOT_FEATURES = ("date", "actual_revenue", "inflation_factor", "CPI")

SLICES = ("category", "segment", "color")

LARGEST_WEIGHT = 1e90

#: Key of a frame that holds one series and has no key of its own.
SINGLE = ("_series",)


def one_per_series(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``df`` with a key that also serves a single series without keys."""
    return df if keys else df.withColumn(SINGLE[0], F.lit(0))


# --- daily roll-up ---------------------------------------------------------------


def priced_lines(
    order_items: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
    products: DataFrame,
    promotions: DataFrame,
    spread: Spread = DEFAULT,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Order lines with day, customer, product labels, returns flag, net revenue and profit.

    Only what the daily series needs: payments, shipments and customers have one row
    per key and would change no daily figure, so they are not joined. ``keys`` are more
    columns of ``orders`` that the lines are to have.

    The order comes last: lines that meet it are placed by order, as the daily series needs them.
    """
    per_order = order_totals(order_items).join(
        orders.select("order_id", "order_date", "customer_id", *keys), "order_id", "left"
    )
    returned = returns_by_line(returns, spread=spread).select(
        "order_id", "product_id", (F.col("return_quantity") > 0).alias("returned")
    )
    labels = products.select("product_id", *SLICES, "cogs")
    lines = attach_promotions(order_items, promotions, probe=order_items, spread=spread)
    lines = join_spread(lines, labels, ["product_id"], "left", order_items, spread)
    lines = attach_to_lines(lines, per_order, [returned], spread, order_items)
    priced = with_net_revenue(lines, clean_type=False)
    return priced.select(
        F.to_date("order_date").alias("date"), "order_id", "customer_id", "product_id",
        "quantity", *SLICES, "actual_revenue",
        gross_profit().alias("gross_profit"),
        F.coalesce(F.col("returned").cast("int"), F.lit(0)).alias("is_returned"), *keys,
    )


def daily_sales(lines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Daily revenue, profit, quantity, returned lines, distinct orders and customers.

    Lines shrink to one row per (day, order, customer) before the distinct counts,
    which otherwise copy every line once per counted column.
    """
    by_order = (
        lines.where(F.col("date").isNotNull())
        .groupBy("date", *keys, "order_id", "customer_id")
        .agg(
            *part_sums("actual_revenue", "revenue"),
            *part_sums("gross_profit", "profit"),
            F.sum("quantity").alias("quantity"),
            F.sum("is_returned").alias("is_returned"),
        )
    )
    return by_order.groupBy("date", *keys).agg(
        whole_sum("revenue").alias("actual_revenue"),
        whole_sum("profit").alias("gross_profit"),
        F.count_distinct("order_id").alias("order_id"),
        sum_or_zero("quantity").alias("quantity"),
        F.count_distinct("customer_id").alias("customer_id"),
        sum_or_zero("is_returned").alias("is_returned"),
    )


def daily_series(
    lines: DataFrame, labels: dict[str, list[str]], keys: tuple[str, ...] = ()
) -> DataFrame:
    """``daily_sales`` with net revenue per label as ``revenue_{column}_{label}``.

    All sums are taken in one pass per day and label combination. The distinct counts
    read the lines again, but only order, customer and day, for which Catalyst drops
    the joins to products, promotions and returns (all but salted ones).
    """
    known = lines.where(F.col("date").isNotNull())
    combined = known.groupBy("date", *keys, *labels).agg(
        *part_sums("actual_revenue", "revenue"),
        *part_sums("gross_profit", "profit"),
        F.sum("quantity").alias("quantity"),
        F.sum("is_returned").alias("is_returned"),
    )
    sums = combined.groupBy("date", *keys).agg(
        whole_sum("revenue").alias("actual_revenue"),
        whole_sum("profit").alias("gross_profit"),
        sum_or_zero("quantity").alias("quantity"),
        sum_or_zero("is_returned").alias("is_returned"),
        *_label_sums(labels),
    ).alias("s")
    counts = known.select("date", *keys, "order_id", "customer_id").distinct().groupBy("date", *keys).agg(
        F.count_distinct("order_id").alias("order_id"),
        F.count_distinct("customer_id").alias("customer_id"),
    ).alias("c")
    same_day = F.col("s.date") == F.col("c.date")
    for key in keys:
        same_day = same_day & F.col(f"s.{key}").eqNullSafe(F.col(f"c.{key}"))
    return sums.join(counts, same_day).select("s.*", "c.order_id", "c.customer_id")


def _label_sums(labels: dict[str, list[str]]) -> list[Column]:
    return [
        whole_sum("revenue", F.col(c) == label).alias(f"revenue_{c}_{label}")
        for c, values in labels.items() for label in values
    ]


def daily_slices_long(lines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(date, slice, label, revenue): net revenue per day and product label."""
    combined = _by_labels(lines, keys)
    return (
        combined.unpivot(
            ["date", *keys, *(f"revenue_{part}" for part in MONEY_PARTS)], list(SLICES), "slice", "label"
        )
        .where(F.col("label").isNotNull())
        .groupBy("date", *keys, "slice", "label")
        .agg(whole_sum("revenue").alias("revenue"))
    )


def daily_slices(
    lines: DataFrame, labels: dict[str, list[str]], keys: tuple[str, ...] = ()
) -> DataFrame:
    """Net revenue per day in one column ``revenue_{slice}_{label}`` per known label.

    Lines are first summed per day and label combination; the wide sums then run over
    that much smaller table.
    """
    return _by_labels(lines, keys).groupBy("date", *keys).agg(*_label_sums(labels))


def daily_slices_sparse(lines: DataFrame, dictionary: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``daily_slices`` with any number of labels: a map of label id to net revenue per day.

    ``dictionary`` is a ``label_dictionary`` of the SLICES; a label without revenue that day is not in the map, a day without labels has no row.
    """
    named = dictionary.select(F.col("column_name").alias("slice"), "label", "label_id")
    known = daily_slices_long(lines, keys).join(named, ["slice", "label"])
    entries = F.sort_array(F.collect_list(F.struct("label_id", "revenue")))
    return known.groupBy("date", *keys).agg(F.map_from_entries(entries).alias("revenues"))


def revenue_columns(rows: DataFrame, ids: dict[tuple[str, str], int]) -> DataFrame:
    """The map of ``daily_slices_sparse`` as a column ``revenue_{slice}_{label}`` for some labels' ids."""
    columns = [
        F.coalesce(F.try_element_at("revenues", F.lit(i).cast("long")), F.lit(0.0)).alias(f"revenue_{c}_{label}")
        for (c, label), i in ids.items()
    ]
    return rows.select(*[c for c in rows.columns if c != "revenues"], *columns)


def _by_labels(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return (
        lines.where(F.col("date").isNotNull())
        .groupBy("date", *keys, *SLICES)
        .agg(*part_sums("actual_revenue", "revenue"))
    )


# --- calendar and flags ----------------------------------------------------------


def with_calendar(df: DataFrame, day: str = "date", harmonics: bool = True) -> DataFrame:
    columns = calendar_columns(day)
    if harmonics:
        columns |= harmonic_columns(day)
    return df.withColumns(columns)


def days_covered(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """The distinct days inside any interval, both ends included.

    Listing the days keeps the lookup an equality join; comparing every day with
    every interval would be a nested loop.
    """
    usable = intervals.where(F.col(start) <= F.col(end))
    return usable.select(F.explode(F.sequence(start, end)).alias("covered")).distinct()


def flag_days(df: DataFrame, days: DataFrame | None, out: str, day: str = "date") -> DataFrame:
    """1 if the row's day is one of ``days`` (first column), else 0; all 0 without ``days``."""
    if days is None:
        return df.withColumn(out, F.lit(0))
    listed = days.select(F.to_date(F.col(days.columns[0])).alias("flag_day")).where(
        F.col("flag_day").isNotNull()
    ).distinct()
    joined = df.join(listed, F.to_date(F.col(day)) == F.col("flag_day"), "left")
    return joined.withColumn(out, F.col("flag_day").isNotNull().cast("int")).drop("flag_day")


def flag_holidays(df: DataFrame, holidays: DataFrame | None, day: str = "date") -> DataFrame:
    return flag_days(df, holidays, "is_holiday", day)


def flag_intervals(
    df: DataFrame,
    intervals: DataFrame | None,
    out: str = "is_promo_active",
    start: str = "start_date",
    end: str = "end_date",
    day: str = "date",
) -> DataFrame:
    """1 on days inside any of the intervals."""
    days = None if intervals is None else days_covered(intervals, start, end)
    return flag_days(df, days, out, day)


# --- windows over a series -------------------------------------------------------


def series_window(order_by: str, partition_by: Iterable[str] = ()):
    return Window.partitionBy(*partition_by).orderBy(order_by)


def add_lags(
    df: DataFrame,
    value: str,
    lags: Iterable[int] = LAGS,
    order_by: str = "date",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """The value n rows (not days) earlier."""
    w = series_window(order_by, partition_by)
    return df.withColumns({f"{value}_lag{n}": F.lag(value, n).over(w) for n in lags})


def rolling(
    value: str,
    n: int,
    stat: str = "mean",
    order_by: str = "date",
    partition_by: Iterable[str] = (),
) -> Column:
    """Mean or sample deviation of the n rows before this one; NULL unless all n have values."""
    frame = series_window(order_by, partition_by).rowsBetween(-n, -1)
    figure = {"mean": F.avg, "std": F.stddev_samp}[stat]
    return F.when(F.count(value).over(frame) == n, figure(value).over(frame))


def ewm_sums(
    df: DataFrame, value: str, span: int, order_by: str = "date", partition_by: Iterable[str] = ()
) -> DataFrame:
    """Add ``__sum`` and ``__norm``: values and counts of the rows so far, weighted 1 - 2 / (span + 1) per row of age.

    Written as running sums of x * decay^-i. Those would overflow on a long series, so
    rows are cut into blocks short enough for the weights; what a block owes to the
    past is the end value of the block before it (a block is long enough for anything
    older to weigh below 1e-90). NULLs have no weight but still age the others.
    """
    keys = tuple(partition_by)
    decay = 1.0 - 2.0 / (span + 1.0)
    block = max(1, int(math.log(LARGEST_WEIGHT) / -math.log(decay)))
    inside = Window.partitionBy(*keys, "__run").orderBy("__place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    previous = Window.partitionBy(*keys).orderBy("__run").rangeBetween(-1, -1)
    place = F.col("__place")

    def running(amount: Column) -> Column:
        weighted = amount * F.pow(F.lit(1.0 / decay), place)
        return F.sum(weighted).over(inside) * F.pow(F.lit(decay), place)

    def with_past(local: str) -> Column:
        before = F.max(F.when(place == block - 1, F.col(local))).over(previous)
        return F.col(local) + F.coalesce(before, F.lit(0.0)) * F.pow(F.lit(decay), place + 1)

    row = F.row_number().over(series_window(order_by, keys)) - 1
    numbered = df.withColumn("__row", row).withColumns({
        "__run": F.floor(F.col("__row") / block).cast("int"),
        "__place": (F.col("__row") % block).cast("int"),
    })
    summed = numbered.withColumns({
        "__own_sum": running(F.coalesce(F.col(value), F.lit(0.0))),
        "__own_norm": running(F.col(value).isNotNull().cast("double")),
    })
    return summed.withColumns({"__sum": with_past("__own_sum"), "__norm": with_past("__own_norm")}).drop(
        "__row", "__run", "__place", "__own_sum", "__own_norm"
    )


def add_ewm(
    df: DataFrame,
    value: str,
    span: int,
    out: str,
    order_by: str = "date",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Exponentially weighted mean of all rows before this one, see ``ewm_sums``."""
    keys = tuple(partition_by)
    today = ewm_sums(df, value, span, order_by, keys).withColumn("__ewm", F.try_divide("__sum", "__norm"))
    return today.withColumn(out, F.lag("__ewm").over(series_window(order_by, keys))).drop("__sum", "__norm", "__ewm")


def add_revenue_windows(
    df: DataFrame,
    value: str = "actual_revenue",
    order_by: str = "date",
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Lags, lag difference, rolling statistics and weighted means of the training matrix."""
    out = add_lags(df, value, LAGS, order_by, partition_by)
    out = out.withColumn("revenue_diff_lag1_lag7", F.col(f"{value}_lag1") - F.col(f"{value}_lag7"))
    windows = {
        f"revenue_roll_mean_{n}_lag1": rolling(value, n, "mean", order_by, partition_by)
        for n in ROLLING_MEANS
    } | {
        f"revenue_roll_std_{n}_lag1": rolling(value, n, "std", order_by, partition_by)
        for n in ROLLING_STDS
    }
    out = out.withColumns(windows)
    for span in EWM_SPANS:
        out = add_ewm(out, value, span, f"revenue_ewma_{span}_lag1", order_by, partition_by)
    return out


def traffic_features(
    traffic: DataFrame,
    day: str = "date",
    keys: tuple[str, ...] = (),
    window: int | None = TRAFFIC_WINDOW,
) -> DataFrame:
    """Per day, the mean sessions of the 30 rows before it (or, without a window, of the last row).

    Several rows of one day are added up first, so that the join keeps the series' rows.
    """
    daily = traffic.groupBy(F.col(day).alias("date"), *keys).agg(F.sum("sessions").alias("sessions"))
    if window is None:
        w = series_window("date", keys)
        return daily.select("date", *keys, F.lag("sessions").over(w).alias("sessions_lag1"))
    column = rolling("sessions", window, "mean", "date", keys)
    return daily.select("date", *keys, column.alias(f"sessions_roll_{window}_lag1"))


# --- training matrices -----------------------------------------------------------


def leaky_columns(columns: Iterable[str]) -> list[str]:
    """Columns not known on the day of a forecast: by part of the name, or by name."""
    return [c for c in columns if c in LEAKY_COLUMNS or any(part in c for part in LEAKY_PARTS)]


def feature_columns(columns: Iterable[str], ignore: Iterable[str] = NOT_FEATURES) -> list[str]:
    ignored = set(ignore)
    return [c for c in columns if c not in ignored]


def training_matrix(
    daily: DataFrame,
    promotions: DataFrame | None = None,
    cpi: DataFrame | None = None,
    holidays: DataFrame | None = None,
    traffic: DataFrame | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Calendar, flags, real revenue and its windows; rows with any NULL are left out.

    NULLs are looked for before leaky columns go, so one of those can remove a row.
    """
    out = with_calendar(daily)
    out = flag_holidays(out, holidays)
    out = flag_intervals(out, promotions)
    out = deflate(out, cpi, partition_by=keys)
    out = add_revenue_windows(out, partition_by=keys)
    leaky = leaky_columns(out.columns)
    if traffic is not None:
        shared = _shared(keys, traffic)
        out = out.join(traffic_features(traffic, keys=shared), ["date", *shared], "left")
    return out.dropna("any").drop(*leaky)


def early_training_matrix(
    daily: DataFrame, traffic: DataFrame | None = None, keys: tuple[str, ...] = (),
    label_columns: tuple[str, ...] = (),
) -> DataFrame:
    """The first feature set: nominal revenue, lags 1 and 7 of EARLY_LAG_COLUMNS and of ``label_columns``.

    ``label_columns`` names revenue columns of labels, such as revenue_color_red. Their lags are
    taken and, being named like leaky columns, dropped with these in the end.
    """
    w = series_window("date", keys)
    out = with_calendar(daily, harmonics=False).drop("dayofyear", "week")
    out = out.withColumns({
        f"{c}_lag{n}": F.lag(c, n).over(w) for c in (*EARLY_LAG_COLUMNS, *label_columns) for n in EARLY_LAGS
    })
    out = out.withColumns({
        "revenue_roll_mean_7_lag1": rolling("actual_revenue", 7, "mean", "date", keys),
        "revenue_roll_std_7_lag1": rolling("actual_revenue", 7, "std", "date", keys),
    })
    leaky = leaky_columns(out.columns)
    if traffic is not None:
        shared = _shared(keys, traffic)
        out = out.join(traffic_features(traffic, keys=shared, window=None), ["date", *shared], "left")
    return out.dropna("any").drop(*leaky)


def _shared(keys: tuple[str, ...], df: DataFrame) -> tuple[str, ...]:
    return tuple(k for k in keys if k in df.columns)


# --- splits ----------------------------------------------------------------------


def _positions(order_by: str, partition_by: Iterable[str]) -> tuple[Column, Column]:
    """Row number and row count of the series."""
    row = F.row_number().over(series_window(order_by, partition_by))
    return row, F.count("*").over(Window.partitionBy(*partition_by))


def chrono_split(
    df: DataFrame, share: float = 0.8, order_by: str = "date", partition_by: Iterable[str] = ()
) -> DataFrame:
    """Add ``is_train``: 1 for the earliest ``share`` of the rows of each series."""
    row, n = _positions(order_by, partition_by)
    return df.withColumn("is_train", (row <= F.floor(F.lit(share) * n)).cast("int"))


def expanding_folds(
    df: DataFrame, n_folds: int = 3, order_by: str = "date", partition_by: Iterable[str] = ()
) -> DataFrame:
    """Add ``fold``: k validates on rows with fold = k and trains on those with fold < k.

    All folds have n // (n_folds + 1) rows; the rest joins the first training block, 0.
    """
    row, n = _positions(order_by, partition_by)
    size = F.floor(n / (n_folds + 1))
    start = n - size * n_folds
    fold = F.when(row <= start, F.lit(0)).otherwise(
        F.floor(F.try_divide(row - 1 - start, size)) + 1
    )
    return df.withColumn("fold", fold.cast("int"))


def last_rows(
    df: DataFrame, n: int, order_by: str = "date", partition_by: Iterable[str] = ()
) -> DataFrame:
    """The last ``n`` rows of each series."""
    w = Window.partitionBy(*partition_by).orderBy(F.desc(order_by))
    return df.withColumn("__from_end", F.row_number().over(w)).where(
        F.col("__from_end") <= n
    ).drop("__from_end")
