"""Range replacement and upserts on tables without DELETE or MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from aljibe.functions.dates import in_window
from aljibe.errors import LoadError
from aljibe.operators.grouping import hashable
from aljibe.session import stage, unstage
from aljibe.sinks.tables import NO_VALUE, create_table, partitions, publish, recover, replace_partitions

#: Column that a bucketed table is partitioned by, and its table properties.
BUCKET, KEYS, BUCKETS = "_bucket", "aljibe.bucket_keys", "aljibe.buckets"


def replaced_range(target: DataFrame, rows: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """``target`` with the rows of (start, end] exchanged for ``rows``.

    Rows without a value in ``column`` are outside every range and stay.
    """
    inside = F.coalesce(in_window(F.col(column), F.lit(start), F.lit(end)), F.lit(False))
    return target.where(~inside).unionByName(rows)


def replace_range(spark: SparkSession, rows: DataFrame, table: str, column: str, start: date, end: date) -> None:
    """Replace (start, end] of ``table`` by ``rows``; running it again gives the same table.

    A table partitioned by the date ``column`` has only the touched days
    rewritten, each pointed to its new folder. Any other table is written anew. A table that does not exist is created from the rows.
    """
    recover(spark, table)
    rows = rows.where(in_window(F.col(column), F.lit(start), F.lit(end)))
    if not spark.catalog.tableExists(table):
        publish(rows, table)
        return
    partitioned_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitioned_by != [column]:
        publish(replaced_range(spark.table(table), rows.select(*spark.table(table).columns), column, start, end), table)
        return
    landed = [name.split("=", 1)[1] for name in partitions(spark, table)]
    replace_partitions(spark, rows, table, column, [day for day in landed if day != NO_VALUE and start < date.fromisoformat(day) <= end])


def replace_days(spark: SparkSession, rows: DataFrame, table: str, column: str, days: set[date]) -> int:
    """Put ``rows`` in the place of the days they have and of ``days``, in a table partitioned by the date ``column``; the rows written. ``rows`` may read the table."""
    return replace_partitions(spark, rows, table, column, [day.isoformat() for day in days])


def day_prints(rows: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Per day of (start, end]: how many rows it has and two sums of their hashes, which do not depend on their order."""
    inside = rows.where(in_window(F.col(column), F.lit(start), F.lit(end)))
    cells = [hashable(F.col(f"`{field.name}`"), field.dataType) for field in sorted(rows.schema, key=lambda field: field.name)]
    marks = [F.struct(*[cell.isNull() for cell in cells]), *cells]
    sums = [F.sum(F.xxhash64(F.lit(seed), *marks).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "_one"), (2, "_two"))]
    return inside.groupBy(F.col(column).alias("_day")).agg(F.count(F.lit(1)).alias("_rows"), *sums)


def changed_days(source: DataFrame, target: DataFrame, column: str, start: date, end: date) -> set[date]:
    """Days of (start, end] on which the rows of ``source`` are not those of ``target``: a row came late, has changed or is gone. Runs a job.

    Both sides are added up per day before anything is shuffled; the driver gets the days that differ.
    """
    target = target.select(*source.columns)
    one, other = (day_prints(rows, column, start, end) for rows in (source, target))
    same = one.join(other.toDF("_day", "_o_rows", "_o_one", "_o_two"), "_day", "full_outer")
    equal = (F.col("_rows") == F.col("_o_rows")) & (F.col("_one") == F.col("_o_one")) & (F.col("_two") == F.col("_o_two"))
    return {row[0] for row in same.where(~F.coalesce(equal, F.lit(False))).select("_day").collect()}


def refresh_range(spark: SparkSession, source: DataFrame, table: str, column: str, start: date, end: date) -> set[date]:
    """Bring the days of (start, end] of a table partitioned by the date ``column`` to what ``source`` has; the days that were rewritten.

    Other days keep their files. ``source`` is read twice: for the sums of all days, and for the rows of the days that differ.
    """
    recover(spark, table)
    days = changed_days(source, spark.table(table), column, start, end)
    if days:
        replace_days(spark, source.where(F.col(column).isin(*days)), table, column, days)
    return days


def upserted(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge by key: matched rows take the columns ``updates`` has, new keys are added.

    Columns missing from ``updates`` keep the target's value, NULL for new rows.
    ``updates`` must hold each key once (``upsert`` checks it); NULL keys match nothing, as in MERGE.
    """
    old, new = target.alias("old"), updates.withColumn("_updated", F.lit(True)).alias("new")
    same = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys]

    def merged(name: str) -> Column:
        if name not in updates.columns:
            return F.col(f"old.{name}")
        return F.when(F.col("new._updated"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return old.join(new, same, "full_outer").select(*[merged(name) for name in target.columns])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def create_bucketed(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], buckets: int) -> None:
    """Create a table of ``schema`` for upserts by ``keys``, unless it exists: partitioned by a column BUCKET, a hash of the keys.

    An upsert rewrites the buckets that its keys fall in. ``buckets`` is for good, so choose it for the size the table will have.
    """
    if not spark.catalog.tableExists(table):
        create_table(spark, table, StructType([*schema.fields, StructField(BUCKET, IntegerType())]), (BUCKET,))
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}', '{BUCKETS}' = '{buckets}')")


def bucket_layout(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Keys and number of buckets of a table made by ``create_bucketed``."""
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return (found[KEYS].split(","), int(found[BUCKETS])) if KEYS in found else None


def touched_buckets(changes: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets that the keys of ``changes`` fall in: at most ``buckets`` numbers, never rows."""
    return sorted(row[0] for row in changes.select(bucket_of(keys, buckets)).distinct().collect())


def replace_buckets(spark: SparkSession, rows: DataFrame, table: str, buckets: Sequence[int]) -> int:
    """Put ``rows`` in the place of all rows of ``buckets``; the rows written. Other buckets keep their files."""
    keys, number = bucket_layout(spark, table)
    return replace_partitions(spark, rows.withColumn(BUCKET, bucket_of(keys, number)), table, BUCKET, [str(bucket) for bucket in buckets])


def upsert(spark: SparkSession, updates: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a table, creating it from ``updates`` if it does not exist. Raises LoadError if two updates have one key.

    In a table that ``create_bucketed`` made for these keys, only the buckets with updates are read and written; any other table is written
    anew. The updates are written to the shared folder first, as they are read three times.
    """
    path = stage(updates)
    try:
        updates = spark.read.schema(updates.schema).parquet(path)
        known = [F.col(key).isNotNull() for key in keys]
        twice = updates.where(reduce(lambda one, other: one & other, known)).groupBy(*keys).count().where("count > 1")
        if found := twice.limit(3).collect():
            raise LoadError(f"several updates for a key of {table}: {[tuple(row)[:-1] for row in found]}")
        recover(spark, table)
        if not spark.catalog.tableExists(table):
            publish(updates, table)
            return
        layout = bucket_layout(spark, table)
        if layout is None or layout[0] != [*keys]:
            publish(upserted(spark.table(table), updates, keys), table)
            return
        touched = touched_buckets(updates, *layout)
        if touched:
            target = spark.table(table).where(F.col(BUCKET).isin(*touched))
            replace_buckets(spark, upserted(target, updates, keys), table, touched)
    finally:
        unstage(spark, path)
