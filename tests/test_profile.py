import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aljibe.functions.numbers import rounded
from aljibe.functions.text import is_email
from aljibe.operators import cleaning, grouping, profile, rules


def test_quantiles_equal_pandas(spark):
    dice = random.Random(3)
    n = 1500
    data = {
        "even": [dice.random() for _ in range(n)],
        "zeros": [0.0 if dice.random() < 0.6 else dice.random() for _ in range(n)],
        "heavy": [dice.paretovariate(0.5) for _ in range(n)],
        "atoms": [dice.choice([0.0, 1.0, dice.random()]) for _ in range(n)],
        "one": [7.0] * n,
    }
    pdf = pd.DataFrame(data)
    pdf.loc[:9, "even"] = None
    fractions = [0.0, 0.25, 0.5, 0.75, 1.0]
    pdf.loc[10:19, "even"] = float("nan")
    got = profile.exact_quantiles(spark.createDataFrame(pdf).select(*data, F.lit(None).cast("double").alias("empty")), [*data, "empty"], fractions)
    for name in data:
        assert got[name] == pytest.approx(pdf[name].dropna().quantile(fractions).tolist(), rel=1e-12)
    assert got["empty"] == [None] * 5


def test_outliers(spark, rows):
    df = spark.createDataFrame([(float(v), None) for v in [*range(1, 12), 100]] + [(None, None)], "v double, empty double")
    series = df.toPandas()["v"].dropna()
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    assert rows(profile.outlier_report(df)) == [
        ("v", round(q1, 3), round(q3, 3), round(q3 - q1, 3), round(q1 - 1.5 * (q3 - q1), 3), round(q3 + 1.5 * (q3 - q1), 3), 1, 8.33)]
    assert profile.outlier_report(df.select("empty")).count() == 0
    assert profile.outlier_report(df.select(F.lit("x").alias("text"))).count() == 0


def test_nan_is_missing(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in range(1, 12)] + [(float("nan"),)], "v double")
    assert rows(profile.outlier_report(df), "outliers", "pct_outliers") == [(0, 0.0)]
    assert rows(profile.describe_numbers(df), "n", "mean", "max") == [(11, 6.0, 11.0)]
    assert rows(profile.missing_report(df)) == [("v", 8.33)]
    assert rows(profile.cardinality_report(df), "nulls", "distinct_values") == [(1, 11)]


@pytest.fixture
def sales(spark):
    """Sales with the defects a profile looks for."""
    data = [
        (1, "Lima ", "a@b.co", 30, 10.0, 2), (1, "Lima ", "a@b.co", 30, 10.0, 2), (2, " BOGOTÁ", "bad", 145, -4.0, 1),
        (3, None, None, None, 5.0, 3), (4, "cali", "c@d.co", -5, 0.0, 1),
    ]
    return spark.createDataFrame(data, "id int, city string, email string, age int, price double, qty int")


def test_missing_cardinality_dictionary(sales, rows):
    assert rows(profile.missing_report(sales)) == sorted([("id", 0.0), ("city", 20.0), ("email", 20.0), ("age", 20.0), ("price", 0.0), ("qty", 0.0)])
    report = {r["column"]: tuple(r)[1:] for r in profile.cardinality_report(sales).collect()}
    assert report["city"] == ("string", 1, 3, 60.0) and report["id"] == ("int", 0, 4, 80.0)
    dictionary = {r["column"]: tuple(r)[1:] for r in profile.data_dictionary(sales, {"id": "Key."}).collect()}
    assert dictionary["id"] == ("Key.", "int", 0, 0.0, 4, "1 | 2 | 3")
    assert dictionary["email"] == ("", "string", 1, 20.0, 3, "a@b.co | bad | c@d.co")
    all_null = profile.data_dictionary(sales.select(F.lit(None).cast("string").alias("x")))
    assert tuple(all_null.first()) == ("x", "", "string", 5, 100.0, 0, "")


@pytest.mark.parametrize("kind, low, high", [("tinyint", -128, 127), ("smallint", -(2**15), 2**15 - 1), ("int", -(2**31), 2**31 - 1), ("bigint", -(2**63), 2**63 - 1)])
def test_bitmaps_count_like_sets(spark, kind, low, high):
    """Neighbours, both ends of the type, both sides of each multiple of 64, repeated values and NULLs."""
    dice = random.Random(kind)
    values = [low, low + 1, high - 1, high, -65, -64, -63, -1, 0, 1, 63, 64, 65, 127, None, None]
    values += [dice.randint(-100, 100) for _ in range(200)] + [dice.randint(low, high) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select(F.col("v").cast(kind).alias("v")).repartition(5)
    row = profile.cardinality_report(df).first()
    assert (row["type"], row["nulls"], row["distinct_values"]) == (kind, 2, len(set(values) - {None}))


def test_cardinality_of_other_types(spark, rows):
    df = spark.sql("""
        SELECT * FROM VALUES
          (DATE'1969-12-31', TIMESTAMP_NTZ'2024-01-01 00:00:00', 1.50BD, true, 0.0D, array(1, NULL), named_struct('a', 1, 'b', 'x')),
          (DATE'1970-01-01', TIMESTAMP_NTZ'2024-01-01 00:00:01', 1.5BD, false, -0.0D, array(1), named_struct('a', 1, 'b', NULL)),
          (DATE'0001-01-01', NULL, 2BD, NULL, double('NaN'), array(1, NULL), named_struct('a', 1, 'b', NULL)),
          (NULL, NULL, NULL, NULL, NULL, NULL, NULL) AS t(day, at, money, flag, `a.b`, items, pair)""")
    assert rows(profile.cardinality_report(df), "column", "nulls", "distinct_values") == sorted([
        ("day", 1, 3), ("at", 2, 2), ("money", 1, 2), ("flag", 2, 2), ("a.b", 2, 1), ("items", 1, 2), ("pair", 1, 2)], key=repr)
    assert rows(profile.data_dictionary(df), "column", "nulls", "distinct_values") == sorted([
        ("day", 1, 3), ("at", 2, 2), ("money", 1, 2), ("flag", 2, 2), ("a.b", 1, 2), ("items", 1, 2), ("pair", 1, 2)], key=repr)
    assert rows(profile.cardinality_report(df.where("false")), "nulls", "distinct_values") == [(0, 0)] * 7


def test_columns_are_scanned_one_by_one(spark, tmp_path):
    """No row is multiplied by the columns, and integers are grouped by words of 64 neighbours before the shuffle."""
    sales = spark.range(100_000, numPartitions=4).select("id", (F.col("id") % 7).cast("string").alias("name"))
    sales.write.parquet(f"{tmp_path}/sales")
    stored = spark.read.parquet(f"{tmp_path}/sales")
    for report in (profile.cardinality_report, profile.data_dictionary):
        plan = report(stored)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "ReadSchema: struct<id:bigint,name:string>" not in plan
        assert "ReadSchema: struct<id:bigint>" in plan and "ReadSchema: struct<name:string>" in plan
    assert "shiftright" in profile.cardinality_report(stored)._jdf.queryExecution().executedPlan().toString()
    assert tuple(profile.distinct_counts(stored, "id").first()) == (100_000, 100_000, 100_000)


def test_describe(sales):
    numbers = {r["column"]: r.asDict() for r in profile.describe_numbers(sales).collect()}
    expected = sales.toPandas()["age"].describe()
    got = numbers["age"]
    assert (got["n"], got["min"], got["max"]) == (4, -5.0, 145.0)
    assert [got[k] for k in ("q1", "median", "q3")] == [expected[k] for k in ("25%", "50%", "75%")]
    assert got["mean"] == round(expected["mean"], 4) and got["std"] == pytest.approx(expected["std"], abs=1e-4)
    words = {r["column"]: tuple(r)[1:] for r in profile.describe_text(sales).collect()}
    assert words["city"] == (4, 3, "Lima ", 2) and words["email"] == (4, 3, "a@b.co", 2)


def test_cleaning_pass_and_comparison(sales, rows):
    c = F.col
    clean = cleaning.clean(
        sales, ["city"], recode={"city": {"bogotá": "bogota"}},
        valid={"age": c("age").between(18, 100), "price": c("price") > 0, "email": is_email(c("email"))},
        recompute={"gross": rounded(c("qty") * c("price"))},
    )
    assert rows(clean) == sorted([
        (1, "lima", "a@b.co", 30, 10.0, 2, 20.0), (2, "bogota", None, None, None, 1, None),
        (3, None, None, None, 5.0, 3, 15.0), (4, "cali", "c@d.co", None, None, 1, None)], key=repr)
    assert rows(profile.before_and_after(sales, clean)) == [("clean", 4, 7, 0, 10), ("raw", 5, 6, 1, 3)]


def test_summary(sales):
    checks = [rules.Rule("price_positive", F.col("price") > 0, "fail"), rules.Rule("age", F.col("age").between(18, 100), "fail")]
    got = {(r["section"], r["name"]): r["value"] for r in profile.dataset_summary(sales, checks, top=2).collect()}
    assert got == {
        ("size", "rows"): 5.0, ("size", "columns"): 6.0, ("size", "exact_duplicates"): 1.0,
        ("missing", "age"): 20.0, ("missing", "city"): 20.0, ("rules", "age"): 60.0, ("rules", "price_positive"): 40.0,
    }


def test_copies_of_nested_rows_are_told_apart(spark):
    """Rows whose plain hashes are equal: items that move between arrays, NULL items, empty arrays, maps and structs."""
    lists = [([1, 2], [3]), ([1], [2, 3]), ([1, None], [5]), ([1], [5]), ([], [7]), ([None], [7])]
    df = spark.createDataFrame(lists, "a array<int>, b array<int>")
    assert df.select(F.xxhash64("a", "b")).distinct().count() < 6
    assert grouping.duplicate_share(df).first().asDict() == {"n_rows": 6, "duplicates": 0, "pct_duplicates": 0.0}
    assert grouping.duplicate_share(df.union(df)).first()["duplicates"] == 6
    nested = [
        ({"k": [1]}, ("x", None), [["a"], ["b"]]), ({"k": [1], "l": None}, ("x", None), [["a"], ["b"]]), ({"k": [1], "l": []}, ("x", None), [["a"], ["b"]]),
        ({"k": [1]}, (None, "x"), [["a"], ["b"]]), ({"k": [1]}, ("x", None), [["a", "b"], []]), ({"k": [1]}, ("x", None), [["a", "b"]]), ({"k": [1]}, None, None),
        (None, None, None), ({}, None, None),
    ]
    df = spark.createDataFrame(nested, "m map<string,array<int>>, s struct<p:string,q:string>, l array<array<string>>")
    assert grouping.duplicate_share(df).first()["duplicates"] == 0
    turned = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},)], "m map<string,int>")
    assert grouping.duplicate_share(turned).first()["duplicates"] == 1
    wide = spark.createDataFrame([tuple(None if i == place else 7 for i in range(70)) for place in (0, 62, 63, 69, 69)], ", ".join(f"c{i} int" for i in range(70)))
    assert sorted(tuple(r) for r in grouping.row_copies(wide).collect()) == [(1, 1), (1, 1), (1, 1), (2, 1)]
