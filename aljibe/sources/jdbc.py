"""Relational sources. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from aljibe.functions.dates import in_window


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
) -> DataFrame:
    """Full snapshot. With ``split_column`` and its bounds the table is read by ``partitions`` tasks.

    The bounds only place the cuts; rows outside them are read as well.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if split_column:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def read_increment(source: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Rows with start < column <= end. Both comparisons are evaluated by the source."""
    return source.where(in_window(F.col(column), F.lit(start), F.lit(end)))
