"""Partial aggregates kept per day, merged when read: a day that is loaded again replaces its own states and nothing else."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from aljibe.functions.numbers import MONEY, money_sum, money_total, nan_to_null, rounded
from aljibe.operators.profile import quantiles_of_counts
from aljibe.sinks.changes import replace_days
from aljibe.sinks.tables import create_table


def keep_states(spark: SparkSession, states: DataFrame, table: str, day: str, days: set[date]) -> int:
    """Put the states of ``days`` in the place of what the table, partitioned by ``day``, has of them; the rows written."""
    create_table(spark, table, states.schema, (day,))
    return replace_days(spark, states.where(F.col(day).isin(*days) if days else F.lit(False)), table, day, days)


def sale_states(sales: DataFrame, paid: str, day: str, by: Sequence[str] = ("customer_id", "country"), amount: str = "gross_amount", at: str = "order_date") -> DataFrame:
    """Per day and group: paid orders, their exact value and the last date."""
    return sales.where(F.col("status") == paid).groupBy(day, *by).agg(
        F.count(F.lit(1)).alias("orders"), money_sum(F.col(amount)).cast(MONEY).alias("value"), F.max(at).alias("last"))


def lifetime_of(states: DataFrame, by: Sequence[str] = ("customer_id", "country")) -> DataFrame:
    """What ``customer_lifetime`` gives for all sales, from the states of their days."""
    return states.groupBy(*by).agg(
        F.sum("orders").alias("paid_orders"), money_total(F.col("value")).alias("lifetime_value"), F.max("last").alias("last_order_date"))


def number_states(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Per day and numeric column: how often each value occurs, NULL and NaN apart. Combined per task before the shuffle."""
    values = df.select(day, *[nan_to_null(F.col(f"`{name}`").cast("double")).alias(name) for name in columns])
    long = values.unpivot([day], [*columns], "column", "value").where("value is not null")
    return long.groupBy(day, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def described(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What ``describe_numbers`` gives for all rows, from the value counts of their days; columns without values are left out. Runs jobs."""
    place = F.array_position(F.array(*[F.lit(name) for name in columns]), F.col("column")).cast("int") - 1
    counts = states.groupBy(place.alias("position"), "value").agg(F.sum("n").alias("n")).where("position >= 0")
    quartiles = quantiles_of_counts(counts, [0.25, 0.5, 0.75])
    means = counts.groupBy("position").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("_mean"))
    apart = counts.join(F.broadcast(means), "position")  # a row per column
    sums = apart.groupBy("position").agg(
        F.sum("n").alias("n"), F.first("_mean").alias("_mean"), F.sum(F.col("n") * F.pow(F.col("value") - F.col("_mean"), 2)).alias("_square"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    known = F.create_map(*[x for at, numbers in quartiles.items() for x in (F.lit(at), F.array(*[F.lit(number) for number in numbers]))]) if quartiles else None
    if known is None:
        schema = "column string, n bigint, mean double, std double, min double, q1 double, median double, q3 double, max double"
        return states.sparkSession.createDataFrame([], schema)
    std = F.when(F.col("n") > 1, F.sqrt(F.col("_square") / (F.col("n") - 1)))
    return sums.select(
        F.element_at(F.array(*[F.lit(name) for name in columns]), F.col("position") + 1).alias("column"), "n", rounded(F.col("_mean"), 4).alias("mean"),
        rounded(std, 4).alias("std"), "min", *[known[F.col("position")][i].alias(name) for i, name in enumerate(("q1", "median", "q3"))], "max")
