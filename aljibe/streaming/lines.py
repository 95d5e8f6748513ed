"""Sales lines as a stream. Every step is stateless, so batch and stream give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aljibe.operators.models import amount_band
from aljibe.streaming.tables import stream_into_table

HIGH_FROM = 500.0


def sales_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id,amount`` lines with their band; lines that are marked bad or have no comma are dropped.

    A number that does not parse is NULL, it does not stop the stream.
    """
    line = F.trim(F.col(column))
    good = lines.where((line != "BAD_LINE") & F.contains(line, F.lit(",")))
    part = F.split(line, ",")
    amount = F.trim(part[1]).try_cast("double")
    return good.select(
        F.trim(part[0]).try_cast("bigint").alias("id"), amount.alias("amount"), amount_band(amount, HIGH_FROM).alias("band")
    )


def squares_of_multiples(df: DataFrame, number: str, factor: int = 3, first: int = 10) -> DataFrame:
    """Squares of the first ``first`` distinct multiples of ``factor``."""
    value: Column = F.col(number)
    multiples = df.where((value > 0) & (value % factor == 0)).select(value.alias("number")).distinct()
    return multiples.orderBy("number").limit(first).select("number", (F.col("number") * F.col("number")).alias("square"))


def stream_sales(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Process the text files that are new since the last run, a bounded number per batch, then stop."""
    return (
        sales_lines(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source))
        .writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_sales_into(spark: SparkSession, source: str, table: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Like ``stream_sales``, into a catalog table; a batch that is run again changes nothing."""
    return stream_into_table(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source), table, checkpoint, sales_lines)
