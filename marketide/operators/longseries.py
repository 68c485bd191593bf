"""Windows over series too long for one task.

The rows of a series are numbered in their order and cut into blocks of a fixed number
of rows, however long the series is; a window then runs over a block. What a block needs
from before it comes in two ways: windows that look back a bounded number of rows get the
last rows of the block before (a halo), and running figures get one carried summary per
block. Numbers come from a range partitioning with counts per task, so no task sees more
than its range, a block with its halo, or the summaries of one series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.operators.series import (
    EWM_SPANS,
    LAGS,
    LARGEST_WEIGHT,
    ROLLING_MEANS,
    ROLLING_STDS,
    ewm_sums,
    rolling,
    series_window,
)
from marketide.session import materialise

#: Rows of a block.
BLOCK_ROWS = 100_000
BLOCK, POSITION = "__block", "__position"

#: Given the column to order by and the columns to partition by, columns by name.
Makers = Callable[[str, tuple[str, ...]], dict[str, Column]]


@dataclass(frozen=True)
class Blocks:
    """Rows with their position in the series (from 0) and their block."""

    rows: DataFrame
    keys: tuple[str, ...]
    size: int

    @property
    def by(self) -> tuple[str, ...]:
        return (*self.keys, BLOCK)

    def attach(self, rows: DataFrame, table: DataFrame, on: Iterable[str]) -> DataFrame:
        """``rows`` with the columns of ``table`` (one row per ``on``, which may be NULL)."""
        named = table.withColumnsRenamed({c: f"__of_{c}" for c in on})
        same = reduce(Column.__and__, [rows[c].eqNullSafe(named[f"__of_{c}"]) for c in on], F.lit(True))
        return rows.join(named, same, "left").drop(*[f"__of_{c}" for c in on])


def cut(df: DataFrame, order_by: Iterable[str], partition_by: Iterable[str] = (), size: int = BLOCK_ROWS) -> Blocks:
    """Number the rows of each series by ``order_by``, which should leave no ties, and cut them into blocks.

    ``df`` is sampled before it is placed, so a long plan should be written first.
    """
    keys, order = tuple(partition_by), [*partition_by, *order_by]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(
        "__at", F.monotonically_increasing_id()
    )
    placed = materialise(numbered).withColumn("__part", F.shiftrightunsigned("__at", 33))
    on = (*keys, "__part")
    runs = placed.groupBy(*on).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")
    shifts = runs.select(*on, shift.alias("__shift"))
    position = F.col("__at") + F.col("__shift")
    rows = Blocks(placed, keys, size).attach(placed, shifts, on).withColumns(
        {POSITION: position, BLOCK: F.floor(position / size).cast("long")}
    )
    return Blocks(rows.drop("__at", "__part", "__shift"), keys, size)


def look_back(blocks: Blocks, makers: Makers, reach: int) -> DataFrame:
    """The rows with the columns of ``makers``, which look back ``reach`` rows at most."""
    if reach > blocks.size:
        raise ValueError(f"a block of {blocks.size} rows cannot show {reach} rows")
    tail = blocks.rows.where(F.col(POSITION) % blocks.size >= blocks.size - reach)
    halo = tail.withColumns({BLOCK: F.col(BLOCK) + 1, "__halo": F.lit(True)})
    both = blocks.rows.withColumn("__halo", F.lit(False)).unionByName(halo)
    return both.withColumns(makers(POSITION, blocks.by)).where("NOT __halo").drop("__halo")


def lag_columns(value: str, lags: Iterable[int] = LAGS) -> Makers:
    return lambda order, by: {f"{value}_lag{n}": F.lag(value, n).over(series_window(order, by)) for n in lags}


def rolling_columns(
    value: str, means: Iterable[int] = ROLLING_MEANS, deviations: Iterable[int] = ROLLING_STDS
) -> Makers:
    return lambda order, by: {
        f"roll_{stat}_{n}": rolling(value, n, stat, order, by)
        for stat, sizes in (("mean", means), ("std", deviations)) for n in sizes
    }


def _carried(blocks: Blocks, ends: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """``figures`` over the blocks up to each in ``ends``, as what the next block starts from."""
    return ends.select(*blocks.keys, (F.col(BLOCK) + 1).alias(BLOCK), *[c.alias(n) for n, c in figures.items()])


def add_ewm(blocks: Blocks, value: str, span: int, out: str) -> Blocks:
    """``series.add_ewm`` of a long series: a block starts from the weighted sums of all rows before it."""
    decay = 1.0 - 2.0 / (span + 1.0)
    place = F.col(POSITION) % blocks.size
    local = ewm_sums(blocks.rows, value, span, POSITION, blocks.by)
    ends = local.where(place == blocks.size - 1).select(*blocks.by, F.struct("__sum", "__norm").alias("__end"))
    # Blocks further back weigh nothing any more.
    some = max(1, math.ceil(math.log(LARGEST_WEIGHT) / -math.log(decay) / blocks.size))
    before = Window.partitionBy(*blocks.keys).orderBy(BLOCK).rowsBetween(1 - some, 0)
    listed = F.collect_list("__end").over(before)

    def folded(field: str) -> Column:
        return F.aggregate(listed, F.lit(0.0), lambda total, end: total * decay**blocks.size + end[field])

    carried = _carried(blocks, ends, {"__past_sum": folded("__sum"), "__past_norm": folded("__norm")})
    rows = blocks.attach(local, carried, blocks.by)
    past_sum, past_norm = F.coalesce("__past_sum", F.lit(0.0)), F.coalesce("__past_norm", F.lit(0.0))
    aged = F.pow(F.lit(decay), place + 1)
    today = F.try_divide(F.col("__sum") + past_sum * aged, F.col("__norm") + past_norm * aged)
    found = rows.withColumn("__today", today).withColumn(
        out, F.when(place == 0, F.try_divide(past_sum, past_norm)).otherwise(
            F.lag("__today").over(series_window(POSITION, blocks.by))
        )
    )
    kept = found.drop("__sum", "__norm", "__past_sum", "__past_norm", "__today")
    return Blocks(kept, blocks.keys, blocks.size)


def add_running_total(blocks: Blocks, value: str, out: str) -> Blocks:
    """The sum of ``value`` up to and with each row; NULLs add nothing."""
    totals = blocks.rows.groupBy(*blocks.by).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__total"))
    upto = Window.partitionBy(*blocks.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    carried = _carried(blocks, totals, {"__past": F.sum("__total").over(upto)})
    rows = blocks.attach(blocks.rows, carried, blocks.by)
    inside = series_window(POSITION, blocks.by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.coalesce("__past", F.lit(0))
    return Blocks(rows.withColumn(out, total).drop("__past"), blocks.keys, blocks.size)


def add_filled(blocks: Blocks, value: str, out: str) -> Blocks:
    """``value``, where missing the last one before, and where there is none the first one after."""
    known = F.when(F.col(value).isNotNull(), F.col(POSITION))
    ends = blocks.rows.groupBy(*blocks.by).agg(F.max_by(value, known).alias("__last"))
    upto = Window.partitionBy(*blocks.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    carried = _carried(blocks, ends, {"__past": F.last("__last", ignorenulls=True).over(upto)})
    firsts = blocks.rows.groupBy(*blocks.keys).agg(F.min_by(value, known).alias("__start"))
    rows = blocks.attach(blocks.attach(blocks.rows, carried, blocks.by), firsts, blocks.keys)
    inside = series_window(POSITION, blocks.by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), "__past", "__start")
    return Blocks(rows.withColumn(out, filled).drop("__past", "__start"), blocks.keys, blocks.size)


def add_revenue_windows(
    df: DataFrame, value: str = "actual_revenue", order_by: Iterable[str] = ("date",),
    partition_by: Iterable[str] = (), size: int = BLOCK_ROWS,
) -> DataFrame:
    """The columns of ``series.add_revenue_windows`` for series of any length."""
    blocks = cut(df, order_by, partition_by, size)
    for span in EWM_SPANS:
        blocks = add_ewm(blocks, value, span, f"revenue_ewma_{span}_lag1")

    def makers(order: str, by: tuple[str, ...]) -> dict[str, Column]:
        rolled = rolling_columns(value)(order, by)
        return lag_columns(value)(order, by) | {f"revenue_{name}_lag1": c for name, c in rolled.items()}

    out = look_back(blocks, makers, max(*LAGS, *ROLLING_MEANS, *ROLLING_STDS))
    difference = F.col(f"{value}_lag1") - F.col(f"{value}_lag7")
    return out.withColumn("revenue_diff_lag1_lag7", difference).drop(BLOCK, POSITION)


def flag_covered(
    df: DataFrame, intervals: DataFrame, out: str = "is_promo_active", at: str = "date",
    start: str = "start_date", end: str = "end_date", size: int = BLOCK_ROWS,
) -> DataFrame:
    """1 for rows whose time lies inside any interval, both ends included, else 0; of any grain.

    Times are swept in order: an interval adds one where it begins and takes one away
    behind its end, and a row is covered where the running sum is above 0. A missing
    start or end leaves the interval open on that side; one that ends before it starts
    covers nothing. Rows without a time are not covered.
    """
    first, last, when = (F.col(c).cast("timestamp") for c in (start, end, at))
    usable = intervals.where(first.isNull() | last.isNull() | (first <= last))
    # Of equal times beginnings come first, then rows, then ends; missing times come before all.
    begins = usable.select(first.alias("__time"), F.lit(0).alias("__kind"), F.lit(1).alias("__step"))
    ends = usable.where(last.isNotNull()).select(last.alias("__time"), F.lit(2).alias("__kind"), F.lit(-1).alias("__step"))
    rows = df.withColumns({"__time": when, "__kind": F.lit(1), "__step": F.lit(0)})
    swept = cut(rows.unionByName(begins.union(ends), allowMissingColumns=True), ["__time", "__kind"], size=size)
    totals = add_running_total(swept, "__step", "__open").rows.where("__kind = 1")
    covered = (F.col("__time").isNotNull() & (F.col("__open") > 0)).cast("int")
    return totals.withColumn(out, covered).select(*df.columns, out)
