"""Catalog tables: creation, typed writes, publishing.

One StructType per table drives its DDL, the casts before a write and the
missing columns, so these cannot disagree. Plain Parquet tables have no
transactions, so rows are written to a folder of their own, and the catalog is then told to look there: a table's location changes in one
statement, a partition's in one each. Old folders stay for readers that have begun, until ``vacuum``. One writer per table at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from aljibe.operators.columns import typed
from aljibe.session import unstage

#: Table properties: folder of a partition switch that has begun, and the table that a complete new table is to replace.
SWITCH, REPLACES = "aljibe.switch", "aljibe.replaces"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
KEEP = timedelta(days=1)


def create_schemas(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_table(spark: SparkSession, table: str, schema: StructType, partitioned_by: tuple[str, ...] = ()) -> None:
    """Create an empty Parquet table from its schema, unless it exists."""
    recover(spark, table)
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        empty.write.format("parquet").partitionBy(*partitioned_by).option("path", new_folder(spark, table)).saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table and all folders written for it."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for folder in _versions(spark, table):
        unstage(spark, folder)


def publish(df: DataFrame, table: str, schema_mode: str = "replace", partitioned_by: tuple[str, ...] = ()) -> int:
    """Overwrite a table, also one that ``df`` reads; the rows written. An empty frame empties it.

    ``schema_mode="merge"`` keeps columns the table has and the frame lacks, filled with NULL; ``"replace"`` takes the frame's columns.
    The rows are written beside the table. A table of the same columns, or with new ones at the end, then gets the new location: one
    statement, or one per partition, which ``recover`` completes after a crash. Any other change of columns drops the old entry and renames the new one; a
    crash between the two is put right by ``recover`` too, which all functions here call first.
    """
    spark = df.sparkSession
    recover(spark, table)
    exists = spark.catalog.tableExists(table)
    if schema_mode == "merge" and exists:
        for field in spark.table(table).schema:
            if field.name not in df.columns:
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    elif schema_mode not in ("merge", "replace"):
        raise ValueError(f"unknown schema mode {schema_mode!r}")
    folder = new_folder(spark, table)
    beside = f"{table}_{folder.rpartition('-')[2]}"
    counted, rows = counting(df.hint("rebalance", *partitioned_by) if partitioned_by else df)
    try:
        counted.write.partitionBy(*partitioned_by).format("parquet").option("path", folder).saveAsTable(beside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        unstage(spark, folder)
        raise
    added = _added_columns(spark, table, beside) if exists else None
    if added is None:
        spark.sql(f"ALTER TABLE {beside} SET TBLPROPERTIES ('{REPLACES}' = '{table}')")
        recover(spark, table)
        return rows()
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    if partitioned_by:
        new = partition_folders(spark, folder)
        switch_partitions(spark, table, folder, {**dict.fromkeys(partitions(spark, table)), **new})
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(folder)}'")
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    return rows()


def _added_columns(spark: SparkSession, table: str, beside: str) -> list[str] | None:
    """DDL of the columns that ``beside`` has after those of ``table``; None if the two differ in any other way."""
    old, new = spark.catalog.listColumns(table), spark.catalog.listColumns(beside)
    if [c.name for c in old if c.isPartition] != [c.name for c in new if c.isPartition]:
        return None
    before, after = ([(c.name, c.dataType) for c in columns if not c.isPartition] for columns in (old, new))
    if after[: len(before)] != before:
        return None
    return [f"`{name}` {kind}" for name, kind in after[len(before) :]]


def recover(spark: SparkSession, table: str) -> None:
    """Complete what a crashed writer has begun: name a complete new table, move the partitions that are not moved yet."""
    schema, _, name = table.rpartition(".")
    shown = spark.sql(f"SHOW TABLES IN {schema or spark.catalog.currentDatabase()} LIKE '{name}_*'").collect()
    for one in [row["tableName"] for row in shown if re.fullmatch(rf"{re.escape(name.lower())}_[0-9a-f]{{12}}", row["tableName"])]:
        beside = f"{schema}.{one}" if schema else one
        if not _location(spark, beside).endswith(f"-{one[-12:]}"):
            continue  # a table of the user's with such a name
        complete = _property(spark, beside, REPLACES) == table
        spark.sql(f"DROP TABLE IF EXISTS {table if complete else beside}")  # one that is not complete was left by a writer that stopped
        if complete:
            spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
            spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{REPLACES}')")
    if spark.catalog.tableExists(table) and (folder := _property(spark, table, SWITCH)):
        _move_partitions(spark, table, folder)


def _property(spark: SparkSession, table: str, key: str) -> str | None:
    return next((row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if row["key"] == key), None)


def new_folder(spark: SparkSession, table: str) -> str:
    """A folder for a new version of a table or of some of its partitions, named by time."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{_schema_folder(spark, table)}/{table.rpartition('.')[2]}-{stamp}-{uuid.uuid4().hex[:12]}"


def _schema_folder(spark: SparkSession, table: str) -> str:
    schema = table.rpartition(".")[0] or spark.catalog.currentDatabase()
    return next(row[1] for row in spark.sql(f"DESCRIBE SCHEMA {schema}").collect() if row[0] == "Location")


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    return next(row[1] for row in spark.sql(f"DESCRIBE FORMATTED {table} {partition}").collect() if row[0] == "Location")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def partitions(spark: SparkSession, table: str) -> list[str]:
    """Partitions as ``column=value``, in the catalog's spelling."""
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def partition_folders(spark: SparkSession, folder: str) -> dict[str, str]:
    """Folder of each partition that a write of one partition column has made below ``folder``."""
    path, system = _path(spark, folder)
    found = [status.getPath() for status in system.listStatus(path) if status.isDirectory() and "=" in status.getPath().getName()]
    return {one.getName(): one.toString() for one in found}


def _clause(spark: SparkSession, table: str, partition: str) -> str:
    """``PARTITION (..)`` for ``column=value``."""
    column, value = partition.split("=", 1)
    if value == NO_VALUE:
        return f"PARTITION (`{column}` = NULL)"
    kind = next(c.dataType for c in spark.catalog.listColumns(table) if c.name == column)
    literal = unquote(value) if kind.endswith("int") else f"{'DATE ' if kind == 'date' else ''}'{_quoted(unquote(value))}'"
    return f"PARTITION (`{column}` = {literal})"


def switch_partitions(spark: SparkSession, table: str, folder: str, targets: dict[str, str | None]) -> None:
    """Give partitions (``column=value``) new folders, or drop those without one.

    What is to be done is written below ``folder`` and named in the table's properties first. Each partition changes in one statement, so it always
    holds old or new rows; a switch that was interrupted is completed by the next writer, or by ``recover``.
    """
    path, system = _path(spark, f"{folder}/switch.json")
    out = system.create(path)
    out.write(bytearray(json.dumps(targets).encode()))
    out.close()
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SWITCH}' = '{_quoted(folder)}')")
    _move_partitions(spark, table, folder)


def _move_partitions(spark: SparkSession, table: str, folder: str) -> None:
    targets = json.loads(spark.read.text(f"{folder}/switch.json", wholetext=True).first()[0])
    for partition, target in targets.items():
        clause = _clause(spark, table, partition)
        if target is not None:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clause} LOCATION '{_quoted(target)}'")
            spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION '{_quoted(target)}'")
        elif partition in partitions(spark, table):
            # a managed table deletes the files of a partition that it drops: it is pointed away from them first
            spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION '{_quoted(folder)}/_dropped/{partition}'")
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clause}")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SWITCH}')")
    spark.catalog.refreshTable(table)


def replace_partitions(spark: SparkSession, rows: DataFrame, table: str, column: str, gone: Iterable[str] = ()) -> int:
    """Put ``rows``, which may read the table, in the place of the partitions they have and of those ``gone`` names by value; the rows written.

    The rows are written once, to a folder that the partitions are then pointed to (``switch_partitions``).
    """
    recover(spark, table)
    folder = new_folder(spark, table)
    # few files per partition, and AQE splits one that is too large for one task
    counted, written = counting(rows.select(*spark.table(table).columns).hint("rebalance", column))
    try:
        counted.write.partitionBy(column).parquet(folder)
    except Exception:
        unstage(spark, folder)
        raise
    new = partition_folders(spark, folder)
    landed = set(partitions(spark, table))
    dropped = {f"{column}={value}" for value in gone} & landed - set(new)
    switch_partitions(spark, table, folder, {**dict.fromkeys(sorted(dropped)), **new})
    return written()


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Folders written for a table, oldest first."""
    path, system = _path(spark, _schema_folder(spark, table))
    shape = re.compile(rf"{re.escape(table.rpartition('.')[2])}-\d{{8}}T\d{{12}}-[0-9a-f]{{12}}")
    found = [status.getPath() for status in system.listStatus(path) if status.isDirectory()] if system.exists(path) else []
    return sorted(one.toString() for one in found if shape.fullmatch(one.getName()))


def vacuum(spark: SparkSession, table: str, keep: timedelta = KEEP) -> list[str]:
    """Delete folders of the table that it no longer looks at and that were followed by another more than ``keep`` ago; their paths.

    Readers that began before that are done by then, or too long to wait for. Only names and dates are read, no rows.
    """
    recover(spark, table)
    plain = lambda folder: re.sub(r"^[a-z]+:/*", "/", folder).rstrip("/")
    root, used = plain(_location(spark, table)), set()
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        used = {plain(_location(spark, table, _clause(spark, table, partition))) for partition in partitions(spark, table)}
    versions, limit, deleted = _versions(spark, table), datetime.now(timezone.utc) - keep, []
    for folder, following in zip(versions, versions[1:]):
        stamp = datetime.strptime(following.rsplit("-", 2)[1], "%Y%m%dT%H%M%S%f").replace(tzinfo=timezone.utc)
        if stamp <= limit:
            parts = partition_folders(spark, folder)
            unused = [one for one in parts.values() if plain(one) not in used]
            deleted += [folder] if len(unused) == len(parts) and plain(folder) != root else unused
    for folder in deleted:
        unstage(spark, folder)
    return deleted


def counting(df: DataFrame):
    """``df``, and a function that gives its rows once it has been written. Costs no job of its own."""
    observed = Observation()
    return df.observe(observed, F.count(F.lit(1)).alias("rows")), lambda: observed.get["rows"]


def append(df: DataFrame, table: str) -> None:
    """Append by column name, also to a partitioned table. An empty frame changes nothing."""
    spark = df.sparkSession
    recover(spark, table)
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=False)
    else:
        publish(df, table)


def write_typed(df: DataFrame, table: str, schema: StructType, mode: str = "overwrite") -> None:
    """Project to the table's columns with its types, then publish or append."""
    rows = typed(df, schema)
    if mode == "overwrite":
        publish(rows, table)
    elif mode == "append":
        append(rows, table)
    else:
        raise ValueError(f"unknown mode {mode!r}")
