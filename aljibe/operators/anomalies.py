"""Revenue drops against the preceding days, and alert rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from aljibe.functions.numbers import rounded

DROP_RATIO = 0.60
DAYS_BACK = 7
MIN_HISTORY = 3


def trailing_means(daily: DataFrame, day: str = "order_date", revenue: str = "total_revenue") -> DataFrame:
    """Mean revenue of the up to seven preceding days that exist, and how many they are.

    Revenue is first added up per day. The window has no partition, but its input
    then is one row per calendar day, whatever frame comes in: a few thousand for years of data.
    """
    before = Window.orderBy(day).rowsBetween(-DAYS_BACK, -1)
    return daily.groupBy(day).agg(F.sum(revenue).alias(revenue)).select(
        F.col(day).alias("run_date"),
        F.col(revenue).alias("revenue"),
        F.avg(revenue).over(before).alias("trailing_mean"),
        F.count(revenue).over(before).alias("history_days"),
    )


def revenue_drops(daily: DataFrame, day: str = "order_date", revenue: str = "total_revenue", min_history: int = MIN_HISTORY) -> DataFrame:
    """Days whose revenue is below 60 % of the trailing mean, given enough history."""
    seen = trailing_means(daily, day, revenue)
    enough = (F.col("history_days") >= min_history) & (F.col("trailing_mean") > 0)
    return (
        seen.where(enough)
        .withColumn("ratio", F.col("revenue") / F.col("trailing_mean"))
        .where(F.col("ratio") < DROP_RATIO)
        .select("run_date", rounded(F.col("revenue")).alias("revenue"), rounded(F.col("trailing_mean")).alias("trailing_mean"), rounded(F.col("ratio"), 4).alias("ratio"))
    )


def revenue_drop_on(daily: DataFrame, run_date: date, day: str = "order_date", revenue: str = "total_revenue", min_history: int = MIN_HISTORY) -> DataFrame:
    """The drop of one day, or no row. Reads that day and the seven before it."""
    last = daily.where(F.col(day) <= F.lit(run_date)).orderBy(F.desc(day)).limit(DAYS_BACK + 1)
    return revenue_drops(last, day, revenue, min_history).where(F.col("run_date") == F.lit(run_date))


def drop_alerts(drops: DataFrame, run_id: str, alert_ts) -> DataFrame:
    message = F.format_string(
        "revenue drop on %s: revenue %.2f, trailing mean %.2f, ratio %.4f",
        F.col("run_date").cast("string"), "revenue", "trailing_mean", "ratio",
    )
    return drops.select(
        F.lit(alert_ts).cast("timestamp").alias("alert_ts"), F.lit(run_id).alias("run_id"),
        F.lit("REVENUE_DROP").alias("alert_type"), F.lit("MEDIUM").alias("severity"), message.alias("message"),
    )


def failure_alerts(events: DataFrame) -> DataFrame:
    """One alert per ERROR event."""
    return events.where(F.col("level") == "ERROR").select(
        F.col("event_ts").alias("alert_ts"), "run_id",
        F.lit("PIPELINE_FAILURE").alias("alert_type"), F.lit("HIGH").alias("severity"),
        F.format_string("[%s/%s] %s", "stage", "dataset", "message").alias("message"),
    )
