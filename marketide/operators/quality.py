"""Data-quality profiles. Every profile is a small table made by one aggregation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from marketide.functions.scalars import is_missing
from marketide.operators.skew import DEFAULT, Spread, join_spread
from marketide.session import materialise

#: Slots of fingerprints, of which some hold a repeated one.
SLOTS = 1 << 20


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, n_null, n_rows) for every column; NaN counts as missing."""
    profiles = []
    for name, df in tables.items():
        floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
        missing = [
            F.coalesce(F.sum(is_missing(f"`{c}`", c in floating).cast("long")), F.lit(0).cast("long"))
            .alias(c)
            for c in df.columns
        ]
        counts = df.agg(F.count("*").alias("__rows"), *missing)
        profiles.append(
            counts.unpivot("__rows", df.columns, "column_name", "n_null").select(
                F.lit(name).alias("table_name"), "column_name", "n_null",
                F.col("__rows").alias("n_rows"),
            )
        )
    return _union(profiles)


def _fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row. Missing values count by their place; -0.0 is 0.0 and all NaN are one."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    plain = [F.col(f"`{c}`") + F.lit(0.0) if c in floating else F.col(f"`{c}`") for c in df.columns]
    # A hash passes over NULLs, so their places are hashed as well.
    missing = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in plain])
    return [F.xxhash64(F.lit(seed), missing, *plain).alias(f"__hash_{seed}") for seed in (1, 2)]


def duplicate_profile(
    tables: dict[str, DataFrame], spread: Spread = DEFAULT, fingerprint: Callable[[DataFrame], list[Column]] = _fingerprint
) -> DataFrame:
    """(table_name, n_rows, n_duplicates): rows that repeat an earlier row.

    Rows are counted by a fingerprint of 16 bytes, so a table without copies shuffles no
    more than that of each row. Only rows whose fingerprint repeats are compared in full:
    copies merge before that shuffle, and different rows with one fingerprint stay apart.
    """
    hashes = ["__hash_1", "__hash_2"]
    marked = {name: df.withColumns(dict(zip(hashes, fingerprint(df)))) for name, df in tables.items()}
    # All tables are counted in one job, known by their places; what repeats is written once.
    each = reduce(DataFrame.union, [df.select(F.lit(i).cast("short").alias("__table"), *hashes) for i, df in enumerate(marked.values())])
    counted = each.groupBy("__table", *hashes).agg(F.count("*").alias("__n"))
    repeated = materialise(counted.where(F.col("__n") > 1)).withColumn("__slot", F.pmod("__hash_1", F.lit(SLOTS)).cast("int"))
    profiles = []
    for i, (name, df) in enumerate(marked.items()):
        own = repeated.where(F.col("__table") == i).drop("__table")
        # Most rows without a copy stay where they are: their slot, of which there are SLOTS, holds no repeated fingerprint.
        slots = own.select("__slot").distinct()
        near = df.withColumn("__slot", F.pmod("__hash_1", F.lit(SLOTS)).cast("int")).join(F.broadcast(slots), "__slot", "left_semi")
        hot = own.where(F.col("__n") > spread.rows_per_task).select(*hashes, F.ceil(F.col("__n") / spread.rows_per_task).cast("int").alias("tasks"))
        suspects = join_spread(near.drop("__slot"), own.select(*hashes), hashes, "inner", probe=df.select(*hashes), spread=spread, hot=hot)
        copies = suspects.groupBy(*[F.col(f"`{c}`") for c in tables[name].columns]).agg(F.count("*").alias("__n"))
        duplicates = copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))
        total = df.agg(F.count("*").alias("n_rows"))
        profiles.append(total.join(duplicates).select(F.lit(name).alias("table_name"), "n_rows", "n_duplicates"))
    return _union(profiles)


def join_reconciliation(
    base: DataFrame, steps: list[tuple[str, DataFrame, list[str]]], base_name: str = "base", spread: Spread = DEFAULT
) -> DataFrame:
    """(step, step_name, n_rows, n_matched) after each left join, without doing the joins.

    A left join turns a row into max(1, matches) rows, so the products of the matches say
    it all and no join fans out. All steps with the same keys share one table of counts
    per key; the keys of the base meet one such table after the other, and frequent keys
    are dealt over many tasks.
    """
    keys = list(dict.fromkeys(k for _, _, on in steps for k in on))
    tables: dict[tuple[str, ...], DataFrame] = {}
    for i, (_, right, on) in enumerate(steps, start=1):
        usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
        matches = right.where(usable).groupBy(*on).agg(F.count("*").alias(f"matches_{i}"))
        known = tables.get(tuple(on))
        tables[tuple(on)] = matches if known is None else known.join(matches, on, "full")
    lines = base.select(*keys)
    for on, counts in tables.items():
        lines = join_spread(lines, counts, list(on), "left", probe=base.select(*on), spread=spread)
    names = [base_name] + [name for name, _, _ in steps]
    rows = [F.lit(1).cast("long")]
    for i in range(1, len(names)):
        rows.append(rows[-1] * F.coalesce(f"matches_{i}", F.lit(1)))
    weighted = lines.select(*[r.alias(f"rows_{i}") for i, r in enumerate(rows)], *[f"matches_{i}" for i in range(1, len(names))])
    totals = [F.count("*").alias("rows_0"), F.count("*").alias("matched_0")]
    for i in range(1, len(names)):
        matched = F.when(F.col(f"matches_{i}").isNotNull(), F.col(f"rows_{i}"))
        totals += [F.sum(f"rows_{i}").alias(f"rows_{i}"), F.sum(matched).alias(f"matched_{i}")]
    entries = F.array(*[
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("step_name"),
            F.coalesce(f"rows_{i}", F.lit(0)).cast("long").alias("n_rows"),
            F.coalesce(f"matched_{i}", F.lit(0)).cast("long").alias("n_matched"),
        )
        for i, name in enumerate(names)
    ])
    return weighted.agg(*totals).select(F.inline(entries))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "column_name", "value")


def value_counts(df: DataFrame, columns: list[str], dropna: bool = True) -> DataFrame:
    """(column_name, value, n): the values of several columns with their counts.

    ``dropna=False`` keeps NULL as a value.
    """
    long = _long(df, columns)
    if dropna:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def cardinality_profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """(column_name, n_unique, n_null). The values themselves: ``value_counts``."""
    if approximate:
        return _long(df, columns).groupBy("column_name").agg(
            F.approx_count_distinct("value").alias("n_unique"),
            F.sum(F.col("value").isNull().cast("long")).alias("n_null"),
        )
    counts = value_counts(df, columns, dropna=False)
    return counts.groupBy("column_name").agg(
        F.count("value").alias("n_unique"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )


def frequency_with_null(df: DataFrame, column: str) -> DataFrame:
    """Label counts, NULL included, most frequent first."""
    return (
        df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(column))
    )


def table_summary(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(table_name, n_rows, n_columns, first_date, last_date)."""
    rows = []
    for name, (df, day) in tables.items():
        first = F.min(day) if day else F.lit(None)
        last = F.max(day) if day else F.lit(None)
        rows.append(
            df.agg(
                F.count("*").alias("n_rows"),
                first.cast("date").alias("first_date"),
                last.cast("date").alias("last_date"),
            ).select(
                F.lit(name).alias("table_name"), "n_rows",
                F.lit(len(df.columns)).alias("n_columns"), "first_date", "last_date",
            )
        )
    return _union(rows)


def preview(df: DataFrame, n: int = 5, order_by: str | None = None, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows, in order if one is named."""
    if order_by is None:
        return df.limit(n)
    order = F.desc(order_by) if last else F.asc(order_by)
    return df.orderBy(order).limit(n)
