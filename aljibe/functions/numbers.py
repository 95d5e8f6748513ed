"""Rounding, coercion and ratios.

Money is summed as DECIMAL so a total does not depend on how rows were split
over tasks, and rounded half up after the decimal cast. Results are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(20,6)"
WIDE_MONEY = "decimal(38,6)"


def rounded(value: Column, digits: int = 2) -> Column:
    return F.round(value.cast(WIDE_MONEY), digits).cast("double")


def money_sum(value: Column) -> Column:
    """Exact sum; a group with only NULLs adds up to 0."""
    return F.coalesce(F.sum(value.cast(MONEY)), F.lit(0).cast(MONEY))


def money_total(value: Column, digits: int = 2) -> Column:
    return F.round(money_sum(value), digits).cast("double")


def money_mean(value: Column, digits: int = 2) -> Column:
    """Exact mean of the non-NULL values, NULL where there are none."""
    return rounded(F.sum(value.cast(MONEY)).cast("double") / F.nullif(F.count(value), F.lit(0)), digits)


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.nullif(whole, F.lit(0)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(share(part, whole) * 100, digits)


def coerced(value: Column, to: str) -> Column:
    """Cast, with NULL for text that does not parse and for NaN."""
    out = value.try_cast(to)
    return nan_to_null(out) if to in ("double", "float") else out


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def sums_to(total: Column, quantity: Column, price: Column, tolerance: float = 0.01) -> Column:
    """total equals quantity * price, rounded to cents, within a tolerance."""
    return F.abs(total - rounded(quantity * price)) < tolerance
