"""File readers. Pipelines pass a schema; inference is for exploration only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from aljibe.errors import EmptyDatasetError
from aljibe.sources.json_arrays import json_rows


def explore_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types. Reads the data twice, so keep it to exploration."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with declared types. Only ``columns`` are parsed; large files are split by the scan."""
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return rows.select(*columns) if columns else rows


def read_json_arrays(spark: SparkSession, root: str, schema: StructType | str | None = None, pattern: str = "*.json") -> DataFrame:
    """Every JSON file below ``root``, each holding one array of documents.

    With a schema large files are read by several tasks (``json_arrays``). Without one it is inferred, for exploration: a file is read by one task.
    """
    if schema is not None:
        return json_rows(spark, root, schema, pattern)
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(root)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in a column ``value``."""
    return spark.read.text(path)


def read_layer(spark: SparkSession, root: str, dataset: str, run_date: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """A layer's Parquet dataset, or one ``run_date`` of it by partition pruning."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(f"{root}/{dataset}")
    return rows if run_date is None else rows.where(F.col("run_date") == F.lit(run_date))


def read_history(spark: SparkSession, root: str, schema: StructType, file_format: str = "csv", pattern: str | None = None) -> DataFrame:
    """All snapshots below ``root`` in one read; an empty frame where there is none yet."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    try:
        return reader.format(file_format).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The frame itself, or EmptyDatasetError. Runs a job that stops at the first row."""
    if df.isEmpty():
        raise EmptyDatasetError(f"{name} has no rows")
    return df
