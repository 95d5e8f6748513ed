import datetime as dt

import pytest
from pyspark.sql import functions as F

from aljibe.errors import DataQualityError, QualityGateError
from aljibe.operators import contracts, rejects, rules, suites
from aljibe.plans import quality, retail
from aljibe.sinks.files import write_json_lines, write_layer
from aljibe.sources.files import read_json_lines

AS_OF = "2025-06-01"


@pytest.fixture(scope="module")
def flagged(quality_data):
    orders, customers = quality_data
    return quality.flagged_orders(orders, customers, quality.order_rules(AS_OF)).cache()


def test_planted_defects_are_quarantined(flagged):
    assert tuple(rules.reconciled(flagged).first()) == (44, 30, 14, True)
    found = {r["item"]: r["n"] for r in rules.quarantined(flagged).transform(
        lambda df: df.select(F.explode("failed_rules").alias("item"))).groupBy("item").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {
        "rule_order_id_not_null": 1, "rule_order_id_unique": 2, "rule_customer_id_not_null": 1, "rule_customer_exists": 2,
        "rule_quantity_range": 1, "rule_unit_price_range": 1, "rule_total_matches": 1, "rule_currency_valid": 1, "rule_currency_matches_country": 2,
        "rule_country_valid": 1, "rule_payment_method_valid": 1, "rule_order_status_valid": 1, "rule_email_valid": 1, "rule_order_ts_not_future": 1,
    }


def test_accepted_rows_keep_the_original_columns(flagged, quality_data):
    orders, _ = quality_data
    silver = rules.accepted(flagged, orders.columns)
    assert silver.columns == orders.columns and silver.exceptAll(orders).isEmpty()


def test_undecided_rules(spark):
    df = spark.createDataFrame([(None,), (1,), (-1,)], "v int")
    checks = [rules.Rule("lenient", F.col("v") > 0), rules.Rule("strict", F.col("v") > 0, "fail")]
    out = rules.with_failed_rules(rules.with_flags(df, checks), checks)
    got = {r["v"]: r["failed_rules"] for r in out.collect()}
    assert got == {None: ["rule_strict"], 1: [], -1: ["rule_lenient", "rule_strict"]}
    report = {r["rule"]: (r["invalid_rows"], r["pct_invalid"]) for r in rules.rule_report(df, checks).collect()}
    assert report == {"lenient": (1, 33.33), "strict": (2, 66.67)}
    with pytest.raises(ValueError):
        rules.holds(rules.Rule("x", F.col("v") > 0, "maybe"))


def test_suites_gate_and_audit(quality_data):
    orders, customers = quality_data
    results = quality.validated(orders, customers, AS_OF).cache()
    failed = {(r["suite"], r["expectation"], r["column"]): r["unexpected"] for r in results.where("not success").collect()}
    assert failed == {
        ("customers_suite", "unique", "customer_id"): 2, ("customers_suite", "between", "signup_date"): 1,
        ("orders_suite", "not_null", "order_id"): 1, ("orders_suite", "unique", "order_id"): 2, ("orders_suite", "not_null", "customer_id"): 1,
        ("orders_suite", "in_set", "country"): 1, ("orders_suite", "in_set", "currency"): 1, ("orders_suite", "between", "quantity"): 1,
        ("orders_suite", "between", "unit_price"): 1, ("orders_suite", "in_set", "payment_method"): 1, ("orders_suite", "in_set", "order_status"): 1,
        ("orders_suite", "regex", "email"): 1, ("orders_suite", "between", "order_ts"): 1, ("orders_fk_suite", "in_set", "customer_exists"): 2,
    }
    assert {r["suite"]: r["success"] for r in suites.gate(results).collect()} == {
        "customers_suite": False, "orders_suite": False, "orders_fk_suite": False, "overall": False}
    assert {r["suite"]: (r["evaluated"], r["successful"], r["unsuccessful"]) for r in suites.audit(results).collect()} == {
        "customers_suite": (7, 5, 2), "orders_suite": (12, 1, 11), "orders_fk_suite": (1, 0, 1)}
    with pytest.raises(QualityGateError, match="customers_suite, orders_fk_suite, orders_suite"):
        suites.require_gate(results)
    suites.require_gate(results.where("success"))


def test_suite_tolerance_nulls_and_column_order(spark):
    df = spark.createDataFrame([("a@b.co",), ("bad",), (None,), ("c@d.co",), ("e@f.co",)], "e string")
    got = {(r["position"]): (r["element_count"], r["null_count"], r["unexpected"], r["unexpected_pct"], r["success"]) for r in suites.run_suite(
        df, [suites.matches("e", "@", mostly=0.75), suites.matches("e", "@", mostly=0.76), suites.not_null("e", mostly=0.8),
             suites.columns_are("e"), suites.columns_are("e", "f"), suites.unique("e")], "s").collect()}
    assert got == {
        0: (5, 1, 1, 25.0, True), 1: (5, 1, 1, 25.0, False), 2: (5, 1, 1, 20.0, True),
        3: (5, 0, 0, 0.0, True), 4: (5, 0, 1, 0.0, False), 5: (5, 1, 0, 0.0, True),
    }
    empty = suites.run_suite(df.where("false"), [suites.matches("e", "@"), suites.unique("e"), suites.not_null("e")], "s")
    assert [r["success"] for r in empty.collect()] == [True, True, True]


@pytest.mark.parametrize("good, mostly", [(55, 0.55), (7, 0.07), (14, 0.14), (28, 0.28), (56, 0.56)])
def test_suite_tolerance_at_the_boundary(spark, good, mostly):
    df = spark.range(100).select(F.when(F.col("id") < good, "yes").otherwise("no").alias("v"))
    checks = [suites.in_set("v", "yes", mostly=mostly), suites.in_set("v", "yes", mostly=mostly + 0.001)]
    assert [r["success"] for r in suites.run_suite(df, checks, "s").orderBy("position").collect()] == [True, False]


def test_results_are_saved_as_json_and_read_back(spark, tmp_path, rows):
    results = suites.run_suite(spark.range(3), [suites.unique("id"), suites.between("id", 0, 1)], "s")
    write_json_lines(results, str(tmp_path / "results"))
    again = read_json_lines(spark, str(tmp_path / "results"), suites.RESULT)
    assert rows(again) == rows(results) and again.columns == results.columns
    assert rows(suites.gate(again)) == [("overall", False), ("s", False)]


def test_run_quality_writes_everything(spark, quality_data):
    orders, customers = quality_data
    spark.sql("CREATE SCHEMA IF NOT EXISTS dq")
    written = quality.run_quality(orders, customers, AS_OF, "dq")
    counts = {name: spark.table(table).count() for name, table in written.items()}
    assert counts == {"dq_results": 20, "dq_validation_audit": 3, "orders_silver": 30, "orders_quarantine": 14, "rule_frequency": 14}
    reconciled = rules.reconciled_tables(orders, spark.table("dq.orders_silver"), spark.table("dq.orders_quarantine"))
    assert tuple(reconciled.first()) == (44, 30, 14, True)
    with pytest.raises(QualityGateError):
        quality.run_quality(orders, customers, AS_OF, "dq", enforce=True)


def orders_frame(spark, *data):
    return spark.createDataFrame(list(data), "order_id string, customer_id string, amount string, order_date string, status string")


def test_reject_reasons_in_order_of_precedence(spark, rows):
    df = orders_frame(
        spark, ("1", "1", "5.0", "2024-01-01", "PAID"), (None, None, None, None, "a"), ("2", "x", "-1", None, "b"), ("3", "1", "abc", None, "c"),
        ("4", "1", "-10", "2024-01-01", "d"), ("5", "1", "0", "someday", "e"), ("6", "1", "nan", "2024-01-01", "f"),
    )
    got = {r["status"]: r["reject_reason"] for r in rejects.with_reject_reason(df).collect()}
    assert got == {
        "PAID": None, "a": "NULL_ORDER_ID", "b": "NULL_CUSTOMER_ID", "c": "NULL_AMOUNT", "d": "NEGATIVE_AMOUNT", "e": "NULL_ORDER_DATE", "f": "NULL_AMOUNT",
    }
    assert rejects.valid_orders(df).count() == 1 and rejects.rejected_orders(df).count() == 6


def test_reject_rate_limit_is_strict(spark):
    good, bad = ("1", "1", "5", "2024-01-01", "s"), (None, "1", "5", "2024-01-01", "s")
    at_limit = orders_frame(spark, *[good] * 93, *[bad] * 7)
    assert rejects.require_reject_rate(at_limit) == (100, 7)
    with pytest.raises(DataQualityError):
        rejects.require_reject_rate(at_limit.union(orders_frame(spark, bad)))
    assert tuple(rejects.reject_rate(at_limit.where("false")).first()) == (0, 0, 0.0)


SILVER = ("order_id string, customer_id string, product_id string, country string, category string, customer_segment string, "
          "quantity string, unit_price string, gross_amount string, status string, amount string")


def test_contract_names_every_failure(spark, rows):
    good = ("1", "1", "1", "ES", "home", "new", "2", "5.0", "10.0", "paid", None)
    bad = ("x", None, "1", "FR", "home", "old", "0", "-1", "9", "paid", "-3")
    twins = ("7", "1", "1", "MX", "books", "new", "1", "1.005", "1.01", "pending", "1")
    df = spark.createDataFrame([good, bad, twins, twins], SILVER)
    got = rows(contracts.check_contract(df, retail.silver_contract(), ["order_id"]))
    assert got == sorted([
        ("7", "order_id", "unique", "7"), ("7", "order_id", "unique", "7"), ("x", "", "gross_amount is quantity * unit_price", None),
        ("x", "amount", "at least 0", "-3.0"), ("x", "country", "allowed value", "FR"), ("x", "customer_id", "not_null", None),
        ("x", "customer_segment", "allowed value", "old"), ("x", "order_id", "type bigint", "x"), ("x", "quantity", "above 0", "0"),
        ("x", "unit_price", "at least 0", "-1.0"),
    ], key=repr)


def test_row_contract_and_raise(spark, rows):
    df = spark.createDataFrame(
        [("1", "1", "1", "2", "2024-01-01 10:00:00", "paid"), ("2", "1", None, "0", "noon", "lost")],
        "order_id string, customer_id string, product_id string, quantity string, order_ts string, status string",
    )
    assert rows(contracts.broken_rows(df, retail.order_contract(), ["order_id"])) == [("2", "product_id,quantity,order_ts,status")]
    failures = contracts.check_contract(df, retail.order_contract(), ["order_id"])
    spark.sql("CREATE SCHEMA IF NOT EXISTS contract")
    with pytest.raises(DataQualityError, match="4 contract failures"):
        contracts.require_contract(failures, "contract.failures")
    contracts.require_contract(failures.where("false"), "contract.failures")


def test_gold_is_not_written_when_silver_breaks_its_contract(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    row = (1, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), 1, 1, "ES", "home", "new", 2, 5.0, 10.0, "paid", 1, 10.0, "EUR", "card", dt.datetime(2024, 1, 1))
    schema = ("order_id bigint, order_date date, order_ts timestamp, customer_id bigint, product_id bigint, country string, category string, customer_segment string, "
              "quantity bigint, unit_price double, gross_amount double, status string, payment_id bigint, amount double, currency string, payment_method string, paid_at timestamp")
    unpriced = (2, *row[1:6], None, *row[7:9], None, None, *row[11:])
    bad = (3, *row[1:5], "XX", *row[6:])
    write_layer(spark.createDataFrame([row, unpriced, bad], schema), silver, "orders", "2024-01-01")
    with pytest.raises(DataQualityError, match="country allowed value"):
        retail.publish_gold(spark, silver, gold, "2024-01-01")
    assert not (tmp_path / "gold").exists()
    write_layer(spark.createDataFrame([row, unpriced], schema), silver, "orders", "2024-01-02")
    retail.publish_gold(spark, silver, gold, "2024-01-02")
    assert spark.read.parquet(f"{gold}/fact_sales").count() == 1


def test_schema_drift_over_landed_versions(spark, tmp_path, rows):
    path = str(tmp_path / "loads")
    spark.createDataFrame([(1, "a", "d1")], "id int, source string, run_date string").write.partitionBy("run_date").parquet(path)
    spark.createDataFrame([(2, "b", "boom", "d2"), (3, "c", None, "d2")], "id int, source string, error_message string, run_date string").write.mode(
        "append").partitionBy("run_date").parquet(path)
    landed = contracts.read_all_versions(spark, path)
    expected = spark.createDataFrame([], "id bigint, source string, error_message string, gone string").schema
    got = rows(contracts.schema_drift(landed, expected, by="run_date"))
    assert got == sorted([
        (day, *rest) for day, fill in (("d1", 0.0), ("d2", 50.0)) for rest in (
            ("id", "bigint", "int", "retyped", 100.0), ("source", "string", "string", "same", 100.0),
            ("error_message", "string", "string", "same", fill), ("gone", "string", None, "missing", 0.0))
    ], key=repr)


def test_types_are_compared_by_what_they_are_made_of(spark, rows):
    def schema(text):
        return spark.createDataFrame([], text).schema

    old = schema("a int, b struct<x:bigint,y:struct<z:date>>, c array<struct<k:float>>, m map<string,int>, d decimal(10,2), e string, f struct<q:int>, g tinyint")
    new = schema("b struct<y:struct<z:timestamp_ntz,w:int>,x:int>, c array<struct<k:double,l:array<int>>>, m map<string,string>, d decimal(12,2), e int, f array<int>, g decimal(3,0), n map<int,struct<o:int>>")
    assert contracts.type_drift(old, new) == [
        ("a", "int", None, "missing"), ("b", "struct", "struct", "same"), ("b.x", "bigint", "int", "narrowed"), ("b.y", "struct", "struct", "same"),
        ("b.y.z", "date", "timestamp_ntz", "widened"), ("b.y.w", None, "int", "added"), ("c", "array", "array", "same"), ("c[]", "struct", "struct", "same"),
        ("c[].k", "float", "double", "widened"), ("c[].l", None, "array", "added"), ("c[].l[]", None, "int", "added"), ("m", "map", "map", "same"), ("m{key}", "string", "string", "same"),
        ("m{value}", "int", "string", "retyped"), ("d", "decimal(10,2)", "decimal(12,2)", "widened"), ("e", "string", "int", "retyped"), ("f", "struct", "array", "retyped"),
        ("g", "tinyint", "decimal(3,0)", "widened"), ("n", None, "map", "added"), ("n{key}", None, "int", "added"), ("n{value}", None, "struct", "added"), ("n{value}.o", None, "int", "added"),
    ]
    df = spark.createDataFrame(
        [([(None, [1])], {"a": (None,)}), ([], {}), (None, None), ([(1.0, None), (2.0, [])], {"b": (5,), "c": None})],
        "c array<struct<k:double,l:array<int>>>, m map<string,struct<o:int>>")
    found = {r.path: r.pct_filled for r in contracts.nested_drift(df, schema("z int, m map<string,struct<o:bigint>>")).collect()}
    assert found == {
        "z": 0.0, "m": 75.0, "m{key}": 50.0, "m{value}": 50.0, "m{value}.o": 25.0, "c": 75.0, "c[]": 50.0, "c[].k": 25.0, "c[].l": 50.0, "c[].l[]": 25.0}
