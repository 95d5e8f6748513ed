"""Streams into catalog tables: a batch that is run again changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from aljibe.sinks.tables import create_table, replace_partitions

#: Column that a stream's table is partitioned by.
BATCH = "_batch"


def write_batch(rows: DataFrame, batch: int, table: str) -> int:
    """Put the rows of a batch in the place of what the table has of that batch; the rows written.

    The id of the batch is kept with its rows, as their partition: a batch that was written, but not noted in the checkpoint, is written once more and gives the same table.
    """
    spark = rows.sparkSession
    create_table(spark, table, StructType([*rows.schema.fields, StructField(BATCH, LongType())]), (BATCH,))
    return replace_partitions(spark, rows.withColumn(BATCH, F.lit(batch).cast("bigint")), table, BATCH, [str(batch)])


def stream_into_table(stream: DataFrame, table: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Process what is new in ``stream``, batch by batch, each ``change``d and written by ``write_batch``, then stop.

    One checkpoint belongs to one table: the ids of its batches are the partitions.
    """
    def write(rows: DataFrame, batch: int) -> None:
        write_batch(change(rows), batch, table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
