"""Lookups, key checks and group sizes.

Checks against other rows look for exceptions: duplicate keys, keys without a
parent. These are found on the key column alone and reduced per task before they
are shuffled. Only that list is joined to the full rows. The NULL-safe join deals
both sides anew, so AQE splits a key that holds too many rows, and turns the join into a
broadcast once it has seen that the list is short. A window over the key would
shuffle every row and hold the largest group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _attach(rows: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a list with one row per key, NULL keys matching each other."""
    there = [f"_key_{place}" for place in range(len(keys))]
    right = listed.withColumnsRenamed(dict(zip(keys, there)))
    condition: Column = F.lit(True)
    for key, name in zip(keys, there):
        condition = condition & F.col(key).eqNullSafe(F.col(name))
    return rows.join(right, condition, "left").drop(*there)


def duplicated_keys(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys of more than one row and how many rows share them; NULLs form a group of their own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "group_size", keys_from: DataFrame | None = None) -> DataFrame:
    """Number of rows sharing the row's keys.

    ``keys_from`` may name a frame with the same keys that costs less to compute than ``df``.
    """
    listed = duplicated_keys(df if keys_from is None else keys_from, keys, "_copies")
    return _attach(df, listed, keys).withColumn(name, F.coalesce("_copies", F.lit(1).cast("bigint"))).drop("_copies")


def unmatched_keys(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Distinct non-NULL values of ``key`` that ``reference`` does not have."""
    used = df.select(key).where(F.col(key).isNotNull()).distinct()
    return used.join(reference.select(F.col(reference_key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")


def with_key_exists(
    df: DataFrame, key: str, reference: DataFrame, reference_key: str, name: str = "key_exists", keys_from: DataFrame | None = None
) -> DataFrame:
    """Whether ``key`` occurs in ``reference``; False for NULL. Duplicate reference keys add no rows.

    ``keys_from`` as in ``with_group_size``.
    """
    listed = unmatched_keys(df if keys_from is None else keys_from, key, reference, reference_key).withColumn("_unmatched", F.lit(True))
    return _attach(df, listed, [key]).withColumn(name, F.col(key).isNotNull() & F.col("_unmatched").isNull()).drop("_unmatched")


def orphans(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Rows whose ``key`` is NULL or not in ``reference``."""
    known = reference.select(F.col(reference_key).alias("_known"))
    return df.join(known, df[key] == F.col("_known"), "left_anti")


def look_up(df: DataFrame, reference: DataFrame, key: str, reference_key: str, columns: dict[str, str]) -> DataFrame:
    """Left join of selected columns, ``columns`` mapping new name to reference column.

    Spark decides on a broadcast from the measured size of the pruned reference.
    """
    right = reference.select(F.col(reference_key).alias("_ref"), *[F.col(c).alias(n) for n, c in columns.items()])
    return df.join(right, df[key] == F.col("_ref"), "left").drop("_ref")


def compare_reports(before: DataFrame, after: DataFrame, key: str, value: str, suffixes: tuple[str, str], delta: str) -> DataFrame:
    """Inner join of two reports on ``key`` with the difference before - after."""
    one, two = f"{value}{suffixes[0]}", f"{value}{suffixes[1]}"
    left = before.select(key, F.col(value).alias(one))
    right = after.select(key, F.col(value).alias(two))
    return left.join(right, key).withColumn(delta, F.round((F.col(one) - F.col(two)).cast("decimal(20,6)"), 2).cast("double"))
