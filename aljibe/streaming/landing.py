"""Landing of files that were not landed before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from aljibe.session import staged
from aljibe.sinks.tables import create_table
from aljibe.streaming.tables import BATCH, stream_into_table, write_batch

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def land_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, pattern: str = "*", files_per_batch: int = 1000) -> StreamingQuery:
    """Copy files not seen by earlier runs into a Parquet table of (path, time, length, content), then stop.

    Which files have landed is kept in the checkpoint; a batch reads a bounded number of files.
    """
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )
    return (
        files.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def land_new_files_into(spark: SparkSession, source: str, table: str, checkpoint: str, pattern: str = "*", files_per_batch: int = 1000) -> StreamingQuery:
    """Like ``land_new_files``, into a catalog table; a batch that is run again changes nothing."""
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(source)
    )
    return stream_into_table(files, table, checkpoint)


def digests_of(files: DataFrame) -> DataFrame:
    """``path`` and ``digest`` (SHA-256 of the content) of files with their content. The content is read, not kept."""
    return files.select("path", F.sha2("content", 256).alias("digest"))


def content_report(offered: DataFrame, landed: DataFrame) -> DataFrame:
    """Every offered path with what it is, by content: both frames have path and digest, as ``digests_of`` gives them.

    ``skipped``: landed under this path with this content; ``changed``: landed under this path with another content only; ``same content``: not landed under this
    path, but under another one; ``new``: not landed. Of offered files with the same new content the first by path is new, the others have the same content.
    Digests are shuffled, never contents.
    """
    known = landed.select(F.col("path").alias("_path"), F.col("digest").alias("_digest")).distinct()
    by_path = known.groupBy("_path").agg(F.collect_set("_digest").alias("_digests"))
    by_content = known.select("_digest").distinct().withColumn("_known", F.lit(True))
    first = F.row_number().over(Window.partitionBy("digest").orderBy("path")) == 1
    met = offered.join(by_path, F.col("path") == F.col("_path"), "left").join(by_content, F.col("digest") == F.col("_digest"), "left").withColumn("_first", first)
    state = (
        F.when(F.array_contains("_digests", F.col("digest")), "skipped").when(F.col("_digests").isNotNull(), "changed")
        .when(F.col("_known") | ~F.col("_first"), "same content").otherwise("new")
    )
    return met.select("path", "digest", state.alias("state"))


def land_changed_files(spark: SparkSession, source: str, table: str, index: str, pattern: str = "*") -> DataFrame:
    """Land the files below ``source`` that are new or changed by content, and return the report of all of them. Runs jobs.

    ``table`` gets path, time, length and content, ``index`` path and digest: it is all that is read of earlier landings, so a file that is changed under its old name is
    seen and a file that has moved is not landed twice. Each run is a batch of both tables; one that stopped between the two is run again.
    Spark's scan passes over files without content.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(source)
    create_table(spark, index, StructType([StructField("path", StringType()), StructField("digest", StringType()), StructField(BATCH, LongType())]), (BATCH,))
    known = spark.table(index)
    batch = known.agg(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0] + 1
    report = staged(content_report(digests_of(files), known))
    wanted = report.where(F.col("state").isin("new", "changed")).select("path", "digest")
    write_batch(files.join(wanted.select("path"), "path", "left_semi"), batch, table)
    write_batch(wanted, batch, index)
    return report


def landing_report(offered: DataFrame, landed: DataFrame) -> DataFrame:
    """Every offered path with "new" or "skipped", given the paths landed before the run."""
    before = landed.select(F.col("path").alias("_path")).distinct().withColumn("_landed", F.lit(True))
    joined = offered.join(before, F.col("path") == F.col("_path"), "left")
    return joined.select("path", F.when(F.col("_landed"), "skipped").otherwise("new").alias("state"))
