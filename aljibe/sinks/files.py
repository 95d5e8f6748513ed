"""File exports and partitioned layer files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_layer(df: DataFrame, root: str, dataset: str, run_date: str, compression: str = "snappy") -> str:
    """Write one ``run_date`` of a layer. Writing the same date again replaces that date only."""
    path = f"{root}/{dataset}"
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("run_date")
        .parquet(path)
    )
    return path


def write_days(df: DataFrame, path: str, day: Sequence[str], rows_per_file: int = 0) -> None:
    """Write Parquet partitioned by ``day`` columns, replacing only the days present in ``df``.

    Rows are gathered per day for few files; AQE splits a day that is too large for one task.
    """
    writer = df.hint("rebalance", *day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*day)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
