"""Loads driven by a control table: full or incremental per source table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from aljibe.errors import LoadError
from aljibe.functions.dates import yesterday
from aljibe.sinks.changes import refresh_range, replace_range, upsert
from aljibe.sinks.tables import publish
from aljibe.sources.jdbc import read_increment

# Columns of the control table, load modes F (full) and I (incremental), the kind whose watermark advances.
CONTROL = "table_name string, last_load date, load_mode string, date_column string, table_kind string"
FULL, INCREMENTAL = "F", "I"
TRANSACTIONAL = "transaccional"


def load_end(spark: SparkSession, as_of: datetime, zone: str = "-05:00") -> date:
    """Last day a load may include: the day before ``as_of`` (UTC) in ``zone``."""
    return spark.range(1).select(yesterday(F.lit(as_of), zone)).first()[0]


def load_table(spark: SparkSession, row: Row, source: DataFrame, target: str, end: date, lookback: int = 0) -> DataFrame | None:
    """Load one table; the control update, or None if the watermark stays.

    With a ``lookback``, an increment first compares that many days up to the watermark with the source and rewrites those that differ, if the target is partitioned by the day
    (``refresh_range``): rows that came late or have changed are loaded once. An increment without a watermark yet takes everything up to ``end``. An empty increment, or a table of another
    kind, leaves the watermark alone. The source is read once, for the one write; the watermark is the newest day written.
    """
    start, day = row["last_load"], F.col(row["date_column"]).cast("date")
    if row["load_mode"] == FULL:
        publish(source, target)
        loaded = spark.table(target)
    elif row["load_mode"] == INCREMENTAL and start is None:
        publish(source.where(day <= F.lit(end)), target)
        loaded = spark.table(target)
    elif row["load_mode"] == INCREMENTAL:
        if lookback and [c.name for c in spark.catalog.listColumns(target) if c.isPartition] == [row["date_column"]]:
            refresh_range(spark, source, target, row["date_column"], start - timedelta(days=lookback), start)
        replace_range(spark, read_increment(source, row["date_column"], start, end), target, row["date_column"], start, end)
        loaded = spark.table(target).where(day > F.lit(start))
    else:
        raise ValueError(f"{row['table_name']}: unknown load mode {row['load_mode']!r}")
    if row["table_kind"] != TRANSACTIONAL:
        return None
    newest = loaded.agg(F.max(day)).first()[0]
    if newest is None:
        return None
    return spark.createDataFrame([(row["table_name"], newest, INCREMENTAL)], "table_name string, last_load date, load_mode string")


def run_control(
    spark: SparkSession,
    control: str,
    source_of: Callable[[str], DataFrame],
    target_schema: str,
    as_of: datetime,
    parallel: int = 4,
    lookback: int = 0,
) -> list[str]:
    """Load every table of the control table; the names loaded, or LoadError naming those that failed.

    The control table has a row per source table. Loads run ``parallel`` at a
    time; watermarks advance together, after the loads that succeeded.
    """
    rows = spark.table(control).collect()
    end = load_end(spark, as_of)

    def load(row: Row) -> tuple[str, DataFrame | None, str | None]:
        try:
            return row["table_name"], load_table(spark, row, source_of(row["table_name"]), f"{target_schema}.{row['table_name']}", end, lookback), None
        except Exception as error:
            return row["table_name"], None, str(error) or repr(error)

    with ThreadPoolExecutor(parallel) as pool:
        outcomes = list(pool.map(load, rows))
    updates = [update for _, update, _ in outcomes if update is not None]
    if updates:
        merged = updates[0]
        for update in updates[1:]:
            merged = merged.unionByName(update)
        upsert(spark, merged, control, ["table_name"])
    errors = {name: error for name, _, error in outcomes if error}
    if errors:
        raise LoadError("; ".join(f"{name}: {error}" for name, error in errors.items()))
    return [name for name, _, _ in outcomes]
