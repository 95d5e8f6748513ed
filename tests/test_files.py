import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from aljibe.errors import EmptyDatasetError
from aljibe.plans.catalog import QUERIES
from aljibe.sinks import files as out
from aljibe.sources import files, gaps, jdbc

SCHEMA = StructType([StructField("id", IntegerType()), StructField("city", StringType()), StructField("amount", DoubleType())])


def test_csv_inferred_and_declared(spark, tmp_path, rows):
    path = tmp_path / "s.csv"
    path.write_text("id,city,amount\n1,Lima,2.5\n2,,\n")
    assert files.explore_csv(spark, str(path)).dtypes == [("id", "int"), ("city", "string"), ("amount", "double")]
    pruned = files.read_csv(spark, str(path), SCHEMA, ["city", "amount"])
    assert rows(pruned) == [("Lima", 2.5), (None, None)]
    assert "ReadSchema: struct<city:string,amount:double>" in pruned._jdf.queryExecution().executedPlan().toString()


def test_large_csv_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id,city,amount\n" + "".join(f"{i},c{i % 7},1.5\n" for i in range(20_000)))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
        df = files.read_csv(spark, str(path), SCHEMA)
        assert df.rdd.getNumPartitions() > 2 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_json_arrays_below_a_root(spark, tmp_path, rows):
    for day, ids in (("2024/01/01", [1, 2]), ("2024/01/02", [3])):
        folder = tmp_path / day
        folder.mkdir(parents=True)
        (folder / "day.json").write_text(json.dumps([{"id": i, "show": {"name": f"s{i}"}} for i in ids], indent=1))
        (folder / "notes.txt").write_text("skip")
    df = files.read_json_arrays(spark, str(tmp_path), "id bigint, show struct<name:string>")
    assert rows(df.select("id", "show.name")) == [(1, "s1"), (2, "s2"), (3, "s3")]


def test_json_lines_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, city string")
    out.write_json_lines(df, str(tmp_path / "j"))
    assert rows(files.read_json_lines(spark, str(tmp_path / "j"), "id int, city string")) == [(1, "a"), (2, None)]
    out.write_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c"), "id int, city string")) == [(1, "a"), (2, None)]


def test_layer_keeps_other_dates_and_prunes(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,)], "id int")
    out.write_layer(df, str(tmp_path), "orders", "2024-01-01")
    out.write_layer(df.unionAll(df), str(tmp_path), "orders", "2024-01-02")
    out.write_layer(spark.createDataFrame([(9,)], "id int"), str(tmp_path), "orders", "2024-01-02")
    day = files.read_layer(spark, str(tmp_path), "orders", "2024-01-02")
    assert rows(day, "id") == [(9,)] and files.read_layer(spark, str(tmp_path), "orders").count() == 2
    assert "PartitionFilters: [isnotnull(run_date" in day._jdf.queryExecution().executedPlan().toString()


def test_days_replace_only_themselves(spark, tmp_path, rows):
    path = str(tmp_path / "days")
    out.write_days(spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string"), path, ["day"])
    out.write_days(spark.createDataFrame([(3, "b")], "id int, day string"), path, ["day"], rows_per_file=10)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_history(spark, tmp_path, rows):
    assert files.read_history(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "orders.csv").write_text("id,city,amount\n1,Lima,2.5\n")
    assert rows(files.read_history(spark, str(tmp_path), SCHEMA, pattern="*.csv")) == [(1, "Lima", 2.5)] * 2


def test_require_rows(spark):
    df = spark.range(2)
    assert files.require_rows(df, "x") is df
    with pytest.raises(EmptyDatasetError):
        files.require_rows(df.where("id > 5"), "x")


def test_missing_days(spark, rows):
    days = [dt.date(2024, 1, d) for d in (1, 1, 3, 9)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    assert rows(gaps.missing_ranges(df, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 4))) == [
        (dt.date(2024, 1, 2), dt.date(2024, 1, 2), 1), (dt.date(2024, 1, 4), dt.date(2024, 1, 4), 1)]
    by_user = spark.createDataFrame([(1, days[0]), (2, days[2])], "u int, day date")
    late = by_user.union(spark.createDataFrame([(3, dt.date(2024, 2, 1)), (4, None)], "u int, day date"))
    assert rows(gaps.missing_ranges(late, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 3), ["u"])) == [
        (1, dt.date(2024, 1, 2), dt.date(2024, 1, 3), 2), (2, dt.date(2024, 1, 1), dt.date(2024, 1, 2), 2),
        (3, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 3), (4, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 3)]


def test_missing_days_of_the_whole_table(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2023, 12, 30)), (1, dt.date(2024, 2, 2)), (2, dt.date(2024, 1, 1)), (3, None)], "u int, day date")
    first, last = dt.date(2023, 12, 30), dt.date(2024, 2, 2)
    assert rows(gaps.missing_ranges(df, "day", by=["u"])) == [
        (1, dt.date(2023, 12, 31), dt.date(2024, 2, 1), 33), (2, first, dt.date(2023, 12, 31), 2), (2, dt.date(2024, 1, 2), last, 32), (3, first, last, 35)]
    assert rows(gaps.missing_ranges(df, "day")) == [(dt.date(2023, 12, 31), dt.date(2023, 12, 31), 1), (dt.date(2024, 1, 2), dt.date(2024, 2, 1), 31)]
    assert rows(gaps.missing_ranges(df.where("day is null"), "day", by=["u"])) == []

    stamps = [(1, "2023-12-30 23:00:00"), (1, "2024-02-02 01:00:00"), (2, "2024-02-01 00:00:00")]
    events = spark.createDataFrame(stamps, "user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert rows(QUERIES["missing_days"](spark, str(tmp_path))) == [
        (1, dt.date(2023, 12, 31), dt.date(2024, 2, 1), 33), (2, first, dt.date(2024, 1, 31), 33), (2, last, last, 1)]


def test_increment_reaches_the_scan(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stamps = ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-03 00:00:00", "2024-01-03 00:00:01"]
    spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, s string").select(
        "id", F.col("s").cast("timestamp_ntz").alias("at")).write.parquet(path)
    df = jdbc.read_increment(spark.read.parquet(path), "at", dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert rows(df, "id") == [(1,), (2,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at," in plan and "LessThanOrEqual(at," in plan


def test_jdbc_options():
    """Options handed to Spark; no database is started for tests."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **more):
            seen.update(more)
            return self

        def load(self):
            return seen

    class Session:
        read = Reader()

    jdbc.read_table(Session(), "jdbc:x", "sales", {"user": "u"}, split_column="id", lower=1, upper=100, partitions=4)
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "sales", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }


def test_jdbc_append_options(spark):
    from aljibe.sinks.jdbc import append_rows

    seen = {}

    class Writer:
        def __getattr__(self, name):
            def call(*args, **more):
                seen.update({args[0]: args[1]} if name == "option" else more if name == "options" else {name: args})
                return self
            return call

    class Frame:
        write = Writer()

    append_rows(Frame(), "jdbc:x", "sales", {"user": "u"}, connections=2)
    assert seen == {"format": ("jdbc",), "url": "jdbc:x", "dbtable": "sales", "numPartitions": "2", "user": "u", "mode": ("append",), "save": ()}
