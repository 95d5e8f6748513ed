"""Dimensions, facts and sales aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from aljibe.functions.dates import calendar, date_key
from aljibe.functions.numbers import money_mean, money_total
from aljibe.operators.columns import select_or_null
from aljibe.operators.grouping import first_per_key
from aljibe.operators.joins import look_up


def dim_from_sources(sources: Sequence[tuple[str, DataFrame]], key: str, kind: str) -> DataFrame:
    """One row per key over several sources; where ids clash the earlier source wins.

    Rows without a key are dropped. ``kind`` names the column for the source's label.
    """
    stacked = None
    for rank, (label, rows) in enumerate(sources):
        rows = rows.where(F.col(key).isNotNull()).withColumns({kind: F.lit(label), "_rank": F.lit(rank)})
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    others = [F.col(c) for c in stacked.columns if c not in (key, kind, "_rank")]
    return first_per_key(stacked, [key], [F.col("_rank"), *others]).drop("_rank")


def dim_by_key(df: DataFrame, schema: StructType, key: str, order: Sequence[Column]) -> DataFrame:
    """Fixed columns, key present, one row per key."""
    return first_per_key(select_or_null(df, schema).where(F.col(key).isNotNull()), [key], order)


def dim_time(days: Column, df: DataFrame) -> DataFrame:
    """Calendar attributes of the days that occur in the data."""
    observed = df.select(days.alias("_day")).where(F.col("_day").isNotNull()).distinct()
    return observed.select(*[value.alias(name) for name, value in calendar(F.col("_day")).items()])


def with_fact_keys(df: DataFrame, days: Sequence[Column], partners: Sequence[Column], partner: str) -> DataFrame:
    """``date_key`` from the first date present and ``partner`` from the first id present."""
    return df.withColumns({"date_key": date_key(F.coalesce(*days)), partner: F.coalesce(*partners)})


def customer_segment(order_day: Column, signup_day: Column, days: int = 30) -> Column:
    """"new" up to ``days`` days after signup, and before it; "existing" otherwise or without a signup."""
    return F.when(F.datediff(order_day, signup_day) <= days, F.lit("new")).otherwise(F.lit("existing"))


def amount_band(amount: Column, limit: float, high: str = "ALTO", low: str = "BAJO") -> Column:
    return F.when(amount >= limit, F.lit(high)).otherwise(F.lit(low))


def daily_sales(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average ticket per day; rows without a date are left out."""
    return orders.where(F.col("order_date").isNotNull()).groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"),
        money_total(F.col("amount")).alias("total_revenue"),
        money_mean(F.col("amount")).alias("avg_ticket"),
    )


def sales_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders and revenue per day and country; orders of unknown customers are left out.

    Orders are added up per day and customer before the join, so a customer with
    a large part of the orders reaches it as one row per day.
    """
    per_customer = (
        orders.where(F.col("order_date").isNotNull() & F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(F.count("order_id").alias("orders"), F.sum(F.col("amount").cast("decimal(20,6)")).alias("revenue"))
    )
    placed = look_up(per_customer, customers, "customer_id", "customer_id", {"country": "country"})
    return placed.where(F.col("country").isNotNull()).groupBy("order_date", "country").agg(
        F.sum("orders").alias("total_orders"),
        F.round(F.coalesce(F.sum("revenue"), F.lit(0)), 2).cast("double").alias("total_revenue"),
    )


def paid_sales_by_day(sales: DataFrame, paid: str, by: Sequence[str] = ("order_date", "country", "category")) -> DataFrame:
    """Sales in status ``paid`` per group: orders, units, revenue, average ticket. NULL groups are kept."""
    return sales.where(F.col("status") == paid).groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_units"),
        money_total(F.col("gross_amount")).alias("total_revenue"),
        money_mean(F.col("gross_amount")).alias("avg_ticket"),
    )


def customer_lifetime(sales: DataFrame, paid: str) -> DataFrame:
    """Paid orders, their value and the last order date per customer and country."""
    return sales.where(F.col("status") == paid).groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("paid_orders"),
        money_total(F.col("gross_amount")).alias("lifetime_value"),
        F.max("order_date").alias("last_order_date"),
    )
