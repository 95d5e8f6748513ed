from pyspark.sql import functions as F

from aljibe.operators import joins


def test_group_size_counts_nulls_together(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    assert rows(joins.with_group_size(df, ["k"], "n")) == [(1, "a", 2), (2, "a", 2), (3, None, 2), (4, None, 2), (5, "b", 1)]


def test_key_exists_adds_no_rows_for_duplicate_references(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, k string")
    reference = spark.createDataFrame([("a",), ("a",), (None,)], "ref string")
    assert rows(joins.with_key_exists(df, "k", reference, "ref", "there")) == [(1, "a", True), (2, "zz", False), (3, None, False)]
    assert rows(joins.orphans(df, "k", reference, "ref")) == [(2, "zz"), (3, None)]


def test_lookup_and_report_comparison(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 99)], "id int, c int")
    reference = spark.createDataFrame([(10, "ES", "x")], "customer int, country string, other string")
    assert rows(joins.look_up(df, reference, "c", "customer", {"country": "country"})) == [(1, 10, "ES"), (2, 99, None)]
    before = spark.createDataFrame([("r1", 4.56), ("r2", 1.0)], "rule string, pct double")
    after = spark.createDataFrame([("r1", 0.4)], "rule string, pct double")
    out = joins.compare_reports(before, after, "rule", "pct", ("_raw", "_clean"), "points")
    assert rows(out) == [("r1", 4.56, 0.4, 4.16)]


def test_one_key_with_most_rows(spark):
    """A third and more of the rows under one key, by broadcast and by sort-merge join."""
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    reference = spark.range(0, 60_000, 6).withColumnRenamed("id", "ref")
    expected = (40_000, 10_000)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            sized = joins.with_group_size(df, ["k"], "n")
            checked = joins.with_key_exists(sized, "k", reference, "ref", "there", keys_from=df)
            got = checked.agg(F.count_if(F.col("n") == 40_000), F.count_if("there"), F.count(F.lit(1))).first()
            assert tuple(got) == (*expected, 60_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_key_is_split_by_aqe(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(400_000).select("id", F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k")).repartition(8).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = joins.with_group_size(spark.read.parquet(path), ["k"], "n")
        assert out.where("n > 1").count() == 266_666
        rows = out.select("id", "n")
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
