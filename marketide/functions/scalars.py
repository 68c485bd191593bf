"""Column expressions shared by the operators."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Calendar harmonics repeat yearly, two of them are used.
YEAR_DAYS = 365.25
HARMONICS = (1, 2)

WHITESPACE = " \t\n\r\f\v"


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def smaller_or_missing(a: Column, b: Column) -> Column:
    """The smaller value; NULL if either is NULL (``least`` alone would skip it)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def clean_label(column: Column | str, missing: str = "none") -> Column:
    return F.coalesce(F.lower(F.trim(as_column(column), F.lit(WHITESPACE))), F.lit(missing))


def joined_labels(column: Column | str) -> Column:
    """Aggregate: the distinct non-null labels in order, '' if there are none."""
    return F.array_join(F.array_sort(F.collect_set(as_column(column))), ", ")


# Money is added up in whole units, millionths and millionths of these, three plain integer
# sums: unlike sums of doubles they do not change with task order and retries, and unlike
# sums of decimals they cost no more than doubles. An amount counts to 1e-12; the sums hold
# up to 9e18 units or 9e12 rows.
MICROS = 1_000_000
MONEY_PARTS = ("units", "micros", "picos")


def money_parts(amount: Column | str) -> tuple[Column, Column, Column]:
    """Whole units, millionths, and millionths of millionths of an amount."""
    value = as_column(amount)
    units = F.floor(value)
    micros = F.rint((value - units) * MICROS)
    picos = F.rint((value - units - micros / MICROS) * MICROS * MICROS)
    return units, micros.cast("long"), picos.cast("long")


def _joined(units: Column, micros: Column, picos: Column) -> Column:
    whole = units.cast("decimal(20,0)") + micros.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    rest = picos.cast("decimal(20,0)") * F.lit(Decimal("0.000000000001"))
    return F.coalesce((whole + rest).cast("double"), F.lit(0.0))


def exact_sum(amount: Column | str, over: WindowSpec | None = None) -> Column:
    """Aggregate: a money sum that is the same in every run; over nothing but NULLs it is 0."""
    sums = [F.sum(p) for p in money_parts(amount)]
    return _joined(*(sums if over is None else [s.over(over) for s in sums]))


def part_sums(amount: Column | str, name: str) -> list[Column]:
    """Aggregates: such a sum left in three columns, for a later ``whole_sum``."""
    return [F.sum(p).alias(f"{name}_{part}") for p, part in zip(money_parts(amount), MONEY_PARTS)]


def whole_sum(name: str, condition: Column | None = None) -> Column:
    """Aggregate: the total of what ``part_sums`` left, of the rows that meet the condition."""
    parts = [F.col(f"{name}_{part}") for part in MONEY_PARTS]
    if condition is not None:
        parts = [F.when(condition, p) for p in parts]
    return _joined(*map(F.sum, parts))


def sum_or_zero(column: Column | str) -> Column:
    return F.coalesce(F.sum(as_column(column)), F.lit(0))


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """Eight calendar fields; weeks start on Monday (0), week numbers are ISO."""
    d = as_column(day)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.day(d),
        "dayofweek": F.weekday(d),
        "is_weekend": F.weekday(d).isin(5, 6).cast("int"),
        "quarter": F.quarter(d),
        "dayofyear": F.dayofyear(d),
        "week": F.weekofyear(d),
    }


def harmonic_columns(day: Column | str) -> dict[str, Column]:
    doy = F.dayofyear(as_column(day))
    out = {}
    for k in HARMONICS:
        angle = F.lit(2 * math.pi * k) * doy / F.lit(YEAR_DAYS)
        out[f"sin_year_{k}"] = F.sin(angle)
        out[f"cos_year_{k}"] = F.cos(angle)
    return out


def not_negative(column: Column | str) -> Column:
    return F.greatest(as_column(column), F.lit(0.0))


def is_missing(column: Column | str, floating: bool) -> Column:
    c = as_column(column)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()
