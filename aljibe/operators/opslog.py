"""Event, alert and dataset-version tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from aljibe.operators.grouping import latest_per_key

# Columns of the three operations tables.
EVENTS = StructType([
    StructField("event_ts", TimestampType()), StructField("level", StringType()), StructField("run_id", StringType()),
    StructField("stage", StringType()), StructField("dataset", StringType()), StructField("status", StringType()),
    StructField("message", StringType()), StructField("rows_ok", LongType()), StructField("rows_reject", LongType()),
    StructField("error_code", StringType()), StructField("extra", StringType()),
])
ALERTS = StructType([
    StructField("alert_ts", TimestampType()), StructField("run_id", StringType()), StructField("alert_type", StringType()),
    StructField("severity", StringType()), StructField("message", StringType()),
])
VERSIONS = StructType([
    StructField("audit_ts", TimestampType()), StructField("run_id", StringType()), StructField("table_name", StringType()),
    StructField("version", LongType()), StructField("operation", StringType()), StructField("operation_ts", TimestampType()),
    StructField("num_output_rows", StringType()), StructField("user_name", StringType()),
])


def log_rows(spark: SparkSession, schema: StructType, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Rows of an operations table as one frame; mappings are stored as JSON text."""
    unknown = {name for row in rows for name in row} - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")

    def cell(value: object) -> object:
        return json.dumps(value, ensure_ascii=False, default=str) if isinstance(value, Mapping) else value

    return spark.createDataFrame([tuple(cell(row.get(name)) for name in schema.names) for row in rows], schema).coalesce(1)


def run_summary(events: DataFrame) -> DataFrame:
    """Per run and stage: first and last time, latest status, rows ok and rejected, errors."""
    return events.groupBy("run_id", "stage").agg(
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.max_by("status", F.struct("event_ts", "status")).alias("last_status"),
        F.count(F.lit(1)).alias("n_events"),
        F.coalesce(F.sum("rows_ok"), F.lit(0)).alias("rows_ok"),
        F.coalesce(F.sum("rows_reject"), F.lit(0)).alias("rows_reject"),
        F.count_if(F.col("level") == "ERROR").alias("errors"),
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """The newest recorded version of each table."""
    return latest_per_key(versions, ["table_name"], ["version", "operation_ts"])
