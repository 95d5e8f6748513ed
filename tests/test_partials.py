import datetime as dt
import random

import pytest

from aljibe.operators import models, partials, profile
from aljibe.plans import retail
from aljibe.sinks import tables
from aljibe.sinks.files import write_layer

D = dt.date


@pytest.fixture
def table(spark):
    tables.create_schemas(spark, "parts")
    yield "parts.states"
    spark.sql("DROP SCHEMA parts CASCADE")


def sales_of(spark, seed, n=400):
    dice = random.Random(seed)
    rows = [(i, dice.choice([1, 2, 3, None]), dice.choice(["ES", "MX", None]), D(2024, 1, 1 + i % 5), dice.choice([0.1, 2.345, None]), dice.choice(["paid", "open"])) for i in range(n)]
    return spark.createDataFrame(rows, "order_id int, customer_id int, country string, order_date date, gross_amount double, status string")


def test_merged_states_equal_the_full_computation(spark, table, rows):
    sales, days = sales_of(spark, 1), {D(2024, 1, n) for n in range(1, 6)}
    for day in sorted(days):
        partials.keep_states(spark, partials.sale_states(sales, "paid", "order_date"), table, "order_date", {day})
    assert rows(partials.lifetime_of(spark.table(table))) == rows(models.customer_lifetime(sales, "paid"))
    # a day that is loaded again, with other orders or none, replaces its states
    other = sales_of(spark, 2).where("order_date = DATE '2024-01-03'")
    changed = sales.where("order_date <> DATE '2024-01-03'").unionByName(other)
    for _ in range(2):
        partials.keep_states(spark, partials.sale_states(other, "paid", "order_date"), table, "order_date", {D(2024, 1, 3)})
        assert rows(partials.lifetime_of(spark.table(table))) == rows(models.customer_lifetime(changed, "paid"))
    partials.keep_states(spark, partials.sale_states(other.where("false"), "paid", "order_date"), table, "order_date", {D(2024, 1, 3)})
    assert rows(partials.lifetime_of(spark.table(table))) == rows(models.customer_lifetime(changed.where("order_date <> DATE '2024-01-03'"), "paid"))


def test_described_states_equal_the_full_description(spark, table, rows):
    dice = random.Random(3)
    data = [(D(2024, 1, 1 + i % 4), dice.gauss(0, 50), dice.choice([1, 2, None]), float("nan") if i % 7 == 0 else float(i), None) for i in range(500)]
    df = spark.createDataFrame(data, "day date, a double, b int, c double, empty double")
    columns = ["a", "b", "c"]
    for n in (1, 2, 3, 4):
        partials.keep_states(spark, partials.number_states(df.where(f"day = DATE '2024-01-0{n}'"), "day", columns), table, "day", {D(2024, 1, n)})
    got = partials.described(spark.table(table), columns)
    want = profile.describe_numbers(df, columns)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert partials.described(partials.number_states(df, "day", ["empty"]), ["empty"]).count() == 0
    one = spark.createDataFrame([(D(2024, 1, 1), 5.0)], "day date, a double")
    assert rows(partials.described(partials.number_states(one, "day", ["a"]), ["a"])) == rows(profile.describe_numbers(one, ["a"]))


def test_lifetime_over_run_dates(spark, tmp_path, rows):
    gold, one, two = str(tmp_path), sales_of(spark, 5), sales_of(spark, 6)
    for run_date, sales in (("2024-02-01", one), ("2024-02-02", one), ("2024-02-02", two)):
        write_layer(partials.sale_states(sales, "paid", "order_date"), gold, "customer_ltv_states", run_date)
    assert rows(retail.lifetime(spark, gold)) == rows(models.customer_lifetime(one.unionByName(two), "paid"))
    assert rows(retail.lifetime(spark, gold, "2024-02-01")) == rows(models.customer_lifetime(one, "paid"))
