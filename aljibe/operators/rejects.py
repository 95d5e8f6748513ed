"""Valid / rejected split of incoming orders and the reject-rate limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.errors import DataQualityError
from aljibe.functions.dates import parsed_date
from aljibe.functions.numbers import coerced, share

REJECT_LIMIT = 0.07


def coerced_orders(df: DataFrame) -> DataFrame:
    """Order columns as numbers and a date; what does not parse is NULL."""
    types = dict(df.dtypes)
    changes = {
        name: coerced(F.col(name), to)
        for name, to in (("order_id", "bigint"), ("customer_id", "bigint"), ("amount", "double"))
        if types[name] != to or to == "double"
    }
    if types["order_date"] != "date":
        changes["order_date"] = parsed_date(F.col("order_date"))
    return df.withColumns(changes)


def reject_reason() -> Column:
    """First rule an order breaks, NULL for a valid one."""
    # fixed values: the reasons, in order of precedence
    return (
        F.when(F.col("order_id").isNull(), "NULL_ORDER_ID")
        .when(F.col("customer_id").isNull(), "NULL_CUSTOMER_ID")
        .when(F.col("amount").isNull(), "NULL_AMOUNT")
        .when(F.col("amount") < 0, "NEGATIVE_AMOUNT")
        .when(F.col("order_date").isNull(), "NULL_ORDER_DATE")
    )


def with_reject_reason(df: DataFrame) -> DataFrame:
    return coerced_orders(df).withColumn("reject_reason", reject_reason())


def valid_orders(df: DataFrame) -> DataFrame:
    return with_reject_reason(df).where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_orders(df: DataFrame) -> DataFrame:
    return with_reject_reason(df).where(F.col("reject_reason").isNotNull())


def reason_counts(df: DataFrame) -> DataFrame:
    return rejected_orders(df).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def reject_rate(df: DataFrame) -> DataFrame:
    """One row: total, rejected and rate; the rate of no rows is 0."""
    flagged = with_reject_reason(df)
    total, rejected = F.count(F.lit(1)), F.count("reject_reason")
    return flagged.agg(total.alias("total"), rejected.alias("rejected"), F.round(share(rejected, total), 6).alias("rate"))


def require_reject_rate(df: DataFrame, limit: float = REJECT_LIMIT) -> tuple[int, int]:
    """Total and rejected rows, or DataQualityError when strictly more than ``limit`` is rejected. Runs one aggregate."""
    row = with_reject_reason(df).agg(F.count(F.lit(1)).alias("total"), F.count("reject_reason").alias("rejected")).first()
    rate = row["rejected"] / row["total"] if row["total"] else 0.0
    if rate > limit:
        raise DataQualityError(f"reject rate {rate:.2%} is above the limit of {limit:.2%}")
    return row["total"], row["rejected"]
