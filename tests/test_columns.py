import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from aljibe.operators import columns, grouping


def test_select_or_null(spark, rows):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = columns.select_or_null(df, StructType([StructField("b", StringType()), StructField("c", LongType())]))
    assert out.dtypes == [("b", "string"), ("c", "bigint")] and rows(out) == [("x", None)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Rating.Average` int, `b-C` int")
    assert columns.tidy_names(df).columns == ["rating_average", "b_c"]
    assert columns.rename(df, {"b-C": "c", "absent": "z"}).columns == ["Rating.Average", "c"]


def test_equal_names_are_merged_from_left_to_right(spark, rows):
    df = spark.createDataFrame([(None, 5.0, 1), (3.0, 4.0, 2)], "`rating_average` double, `rating.average` double, id int")
    out = columns.tidy_names(df)
    assert out.columns == ["rating_average", "id"] and rows(out) == [(3.0, 2), (5.0, 1)]


def test_flatten(spark, rows):
    df = spark.createDataFrame(
        [(1, ((7, None), ["a"]))], "id int, show struct<network:struct<id:int,`country code`:string>,genres:array<string>>"
    )
    out = columns.flatten(df)
    assert out.columns == ["id", "show_network_id", "show_network_country code", "show_genres"]
    assert rows(out) == [(1, 7, None, ["a"])]


def test_lineage_is_repeatable(spark, rows):
    df = spark.createDataFrame([(1,)], "a int")
    out = columns.with_lineage(df, "d", "f.csv", "b1", "2024-01-01T00:00:00", "2024-01-01")
    assert rows(out) == [(1, "d", "f.csv", "b1", "2024-01-01T00:00:00", "2024-01-01")]


def test_typed_is_strict_or_coercing(spark, rows):
    schema = StructType([StructField("n", IntegerType()), StructField("d", DateType()), StructField("missing", StringType())])
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "never")], "n string, d string")
    assert rows(columns.typed(df, schema, coerce=True)) == [(1, dt.date(2024, 1, 1), None), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.typed(df, schema).collect()


def test_dedupe_compares_maps_by_content(spark, rows):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (1, None)], "k int, m map<string,int>")
    out = grouping.dedupe_rows(df)
    assert rows(out.select("k", F.map_entries("m"))) == [(1, None), (1, [("a", 1), ("b", 2)])]
    assert dict(out.dtypes)["m"] == "map<string,int>"


def test_first_and_latest_per_key(spark, rows):
    data = [("a", 1, "old"), ("a", 2, "new"), ("a", None, "undated"), (None, 1, "x"), (None, 3, "y"), ("b", None, "only")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(grouping.latest_per_key(df, ["k"], ["t"]), "k", "v") == [("a", "new"), ("b", "only"), (None, "y")]
    tied = spark.createDataFrame([("a", 1, v) for v in "pqrs"], "k string, t int, v string")
    picks = {rows(grouping.latest_per_key(tied.orderBy(F.rand(seed)), ["k"], ["t"]))[0] for seed in range(4)}
    assert len(picks) == 1


def test_counts_and_totals(spark, rows):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), (None, 5.0), ("y", None), (None, 1.0)], "c string, v double")
    assert [tuple(r) for r in grouping.top_values(df, "c", 2).collect()] == [("x", 2), (None, 2)]
    partials = grouping.partial_totals(df, ["c"], "v", F.lit(1)).unionByName(grouping.partial_totals(df, ["c"], "v", F.lit(2)))
    assert rows(grouping.merged_totals(partials, ["c"])) == [("x", 6.0), ("y", 0.0), (None, 12.0)]
    assert rows(grouping.duplicate_share(df.select("c"))) == [(5, 2, 40.0)]
    assert rows(grouping.duplicate_share(df.where("false"))) == [(0, 0, 0.0)]
    assert spark.createDataFrame([(2,), (3,), (5,)], "n int").transform(grouping.product_by, [], F.col("n")).first()[0] == 30.0
    assert rows(grouping.table_stats(df, "v")) == [(5, 1.0, 5.0, 9.0, 2.25)]
