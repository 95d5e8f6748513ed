import datetime as dt

import pytest
from pyspark.sql import functions as F

from aljibe.errors import DataQualityError, LoadError
from aljibe.operators.opslog import latest_versions
from aljibe.plans import control
from aljibe.plans.daily import DailyLoad
from aljibe.sinks.tables import publish
from aljibe.streaming import landing, lines

D = dt.date
LANDED_ORDERS = "order_id string, customer_id string, order_date string, amount string, status string"
DAILY_COLUMNS = ("order_date", "total_orders", "total_revenue", "avg_ticket")
LANDED_CUSTOMERS = "customer_id int, customer_name string, country string, email string, updated_at timestamp"


def landed(spark, day, amount, rejects=0):
    data = [(str(i), "1" if i % 2 else "2", str(day), str(amount), "PAID") for i in range(100 - rejects)]
    data += [(None, "1", str(day), "5", "PAID")] * rejects
    customers = [(1, "Ana", "ES", "a@b.co", dt.datetime(2024, 1, 1)), (1, "Ana M", "MX", "a@b.co", dt.datetime(day.year, day.month, day.day)), (2, "Luis", "AR", "l@b.co", dt.datetime(2024, 1, 1))]
    return spark.createDataFrame(data, LANDED_ORDERS), spark.createDataFrame(customers, LANDED_CUSTOMERS)


def test_daily_load(spark, rows):
    def run(day, amount, rejects=0):
        load = DailyLoad(spark, day, f"run-{day}", "elt", now=dt.datetime(2024, 2, 1))
        return load.run(*landed(spark, day, amount, rejects))

    days = [D(2024, 1, d) for d in range(1, 5)]
    assert [run(day, 10.0) for day in days[:3]] == [False, False, False]
    assert run(days[3], 5.0, rejects=2) is True
    daily = spark.table("elt_gold.daily_sales")
    assert rows(daily, *DAILY_COLUMNS) == [(day, 100, 1000.0, 10.0) for day in days[:3]] + [(days[3], 98, 490.0, 5.0)]
    assert rows(spark.table("elt_gold.sales_by_country").where(F.col("order_date") == days[3]), "country", "total_orders") == [("AR", 49), ("MX", 49)]
    assert spark.table("elt_silver.orders_reject").count() == 2
    assert spark.table("elt_ops.pipeline_alerts").where("alert_type = 'REVENUE_DROP'").count() == 1

    # the same day again replaces it everywhere
    assert run(days[3], 10.0) is False
    assert rows(spark.table("elt_gold.daily_sales"), *DAILY_COLUMNS) == [(day, 100, 1000.0, 10.0) for day in days]
    versions = {r["table_name"]: (r["version"], r["num_output_rows"]) for r in latest_versions(spark.table("elt_ops.dataset_versions")).collect()}
    assert versions["elt_silver.orders"] == (4, "100") and versions["elt_bronze.orders"] == (4, "100")  # rows written, not rows of the table
    before = rows(spark.table("elt_silver.orders"), "order_id", "_run_date")
    again = DailyLoad(spark, days[3], "rebuild", "elt")
    again.silver(rebuild=True)
    assert rows(spark.table("elt_silver.orders"), "order_id", "_run_date") == before

    # a late order of an old day rewrites that day only
    def files():
        return {r[0]: r[1] for r in spark.table("elt_gold.daily_sales").groupBy("order_date").agg(F.min(F.col("_metadata.file_path"))).collect()}

    late, customers = landed(spark, days[3], 10.0)
    old, gold = files(), spark.createDataFrame([("500", "1", str(days[0]), "50", "PAID")], LANDED_ORDERS)
    DailyLoad(spark, days[3], "late", "elt", now=dt.datetime(2024, 2, 1)).run(late.union(gold), customers)
    new = files()
    assert {day for day in days if old[day] != new[day]} == {days[0], days[3]}
    assert rows(spark.table("elt_gold.daily_sales"), *DAILY_COLUMNS) == [(days[0], 101, 1050.0, 10.4)] + [(day, 100, 1000.0, 10.0) for day in days[1:]]
    run(days[3], 10.0)  # without the late order its day is as before
    assert rows(spark.table("elt_gold.daily_sales"), *DAILY_COLUMNS) == [(day, 100, 1000.0, 10.0) for day in days]

    # too many rejects stop the load before silver changes
    with pytest.raises(DataQualityError):
        run(D(2024, 1, 5), 10.0, rejects=8)
    assert spark.table("elt_silver.orders").count() == 400
    failed = spark.table("elt_ops.pipeline_events").where("level = 'ERROR'").first()
    assert (failed["stage"], failed["error_code"]) == ("silver", "DQ_001")
    assert spark.table("elt_ops.pipeline_alerts").where("alert_type = 'PIPELINE_FAILURE'").count() == 1


def test_late_and_missing_customers(spark, rows):
    def run(day, orders, customers):
        load = DailyLoad(spark, day, f"run-{day}", "late", now=dt.datetime(2024, 2, day.day))
        load.run(spark.createDataFrame(orders, LANDED_ORDERS), spark.createDataFrame(customers, LANDED_CUSTOMERS))
        return rows(spark.table("late_gold.sales_by_country"), "order_date", "country", "total_orders")

    one, two, three = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    ana, luis = (1, "Ana", "ES", "a@b.co", dt.datetime(2024, 1, 1)), (2, "Luis", "AR", "l@b.co", dt.datetime(2024, 1, 1))
    moved = (1, "Ana", "MX", "a@b.co", dt.datetime(2024, 1, 3))
    orders = {day: [(f"{day.day}1", "1", str(day), "10", "PAID"), (f"{day.day}2", "2", str(day), "10", "PAID")] for day in (one, two, three)}
    assert run(one, orders[one], [ana]) == [(one, "ES", 1)]
    assert run(two, orders[two], [luis]) == [(day, c, 1) for day in (one, two) for c in ("AR", "ES")]  # the order of day one came before its customer
    assert run(three, orders[three], [moved]) == [(day, c, 1) for day in (one, two, three) for c in ("AR", "MX")]
    # day three again, without the customer: the older version counts again
    assert run(three, orders[three], [luis]) == [(day, c, 1) for day in (one, two, three) for c in ("AR", "ES")]
    # day two again, without Luis there: day three still has Luis
    assert run(two, orders[two], [ana]) == [(day, c, 1) for day in (one, two, three) for c in ("AR", "ES")]
    assert rows(spark.table("late_silver.customers"), "customer_id", "country") == [(1, "ES"), (2, "AR")]


def test_load_end(spark):
    assert control.load_end(spark, dt.datetime(2024, 3, 2, 4, 59)) == D(2024, 2, 29)


def test_control_table_runs(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS ctl")
    publish(spark.createDataFrame(
        [("sales", None, "F", "sold", "transaccional"), ("clients", D(2020, 1, 1), "F", "since", "maestra")], control.CONTROL), "ctl.control")
    data = {
        "sales": spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "id int, sold date"),
        "clients": spark.createDataFrame([(7, D(2019, 1, 1))], "id int, since date"),
    }

    def run(as_of):
        return control.run_control(spark, "ctl.control", data.__getitem__, "ctl", as_of)

    def state():
        return rows(spark.table("ctl.control"), "table_name", "last_load", "load_mode")

    assert sorted(run(dt.datetime(2024, 1, 3, 12))) == ["clients", "sales"]
    assert state() == [("clients", D(2020, 1, 1), "F"), ("sales", D(2024, 1, 2), "I")]
    # the increment ends yesterday; rows of today wait
    data["sales"] = data["sales"].union(spark.createDataFrame([(3, D(2024, 1, 4)), (4, D(2024, 1, 6))], "id int, sold date"))
    run(dt.datetime(2024, 1, 6, 12))
    assert rows(spark.table("ctl.sales"), "id") == [(1,), (2,), (3,)] and state()[1] == ("sales", D(2024, 1, 4), "I")
    # an empty increment keeps the watermark
    run(dt.datetime(2024, 1, 6, 13))
    assert rows(spark.table("ctl.sales"), "id") == [(1,), (2,), (3,)] and state()[1] == ("sales", D(2024, 1, 4), "I")
    # without a watermark or a target, an increment takes everything up to its end
    data["stock"] = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 9))], "id int, day date")
    publish(spark.table("ctl.control").union(spark.createDataFrame([("stock", None, "I", "day", "transaccional")], control.CONTROL)), "ctl.control")
    run(dt.datetime(2024, 1, 6, 14))
    assert rows(spark.table("ctl.stock"), "id") == [(1,)] and state()[2] == ("stock", D(2024, 1, 1), "I")
    # one failing table does not keep the other from its load, and is reported
    del data["clients"]
    with pytest.raises(LoadError, match="clients"):
        run(dt.datetime(2024, 1, 8, 12))
    assert rows(spark.table("ctl.sales"), "id") == [(1,), (2,), (3,), (4,)] and state()[1] == ("sales", D(2024, 1, 6), "I")


def test_stream_equals_batch_and_resumes(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("0,499.99\nBAD_LINE\n1,500\nno comma\n2,x\n")
    lines.stream_sales(spark, source, target, checkpoint).awaitTermination()
    expected = [(0, 499.99, "BAJO"), (1, 500.0, "ALTO"), (2, None, "BAJO")]
    assert rows(spark.read.parquet(target)) == expected == rows(lines.sales_lines(spark.read.text(source)))
    (tmp_path / "in" / "2.txt").write_text("3,900\n")
    for _ in range(2):
        lines.stream_sales(spark, source, target, checkpoint).awaitTermination()
        assert rows(spark.read.parquet(target)) == expected + [(3, 900.0, "ALTO")]


def test_only_new_files_land(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"1")
    (tmp_path / "in" / "skip.tmp").write_bytes(b"x")
    landing.land_new_files(spark, source, target, checkpoint, "*.csv").awaitTermination()
    landed_before = spark.read.parquet(target).cache()
    assert rows(landed_before, "length", "content") == [(1, bytearray(b"1"))]
    (tmp_path / "in" / "b.csv").write_bytes(b"22")
    offered = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(source).select("path")
    report = landing.landing_report(offered, landed_before).select(F.regexp_extract("path", "([^/]+)$", 1), "state")
    assert rows(report) == [("a.csv", "skipped"), ("b.csv", "new")]
    landing.land_new_files(spark, source, target, checkpoint, "*.csv").awaitTermination()
    assert rows(spark.read.parquet(target), "length") == [(1,), (2,)]


def test_squares(spark):
    out = lines.squares_of_multiples(spark.range(1, 101), "id")
    assert [tuple(r) for r in out.collect()] == [(3 * i, 9 * i * i) for i in range(1, 11)]


def test_customers_rewrite_their_buckets_only(spark, rows, monkeypatch):
    """The second day has one new customer: other buckets keep their files, and bronze customers of earlier days are not read."""
    from aljibe.sinks.changes import BUCKET

    def run(day, customers):
        order = (f"{day.day}", "1", str(day), "10", "PAID")
        load = DailyLoad(spark, day, f"run-{day}", "buck", now=dt.datetime(2024, 2, day.day))
        load.run(spark.createDataFrame([order], LANDED_ORDERS), spark.createDataFrame(customers, LANDED_CUSTOMERS))
        found = spark.table("buck_silver.customers").groupBy(BUCKET).agg(F.min("_metadata.file_path")).collect()
        return load, {r[0]: r[1] for r in found}

    many = [(i, f"n{i}", "ES", "a@b.co", dt.datetime(2024, 1, 1)) for i in range(200)]
    load, first = run(D(2024, 1, 1), many)
    assert len(first) == 16 and load.loaded_before is False
    load, second = run(D(2024, 1, 2), [(1000, "new", "MX", "a@b.co", dt.datetime(2024, 1, 2))])
    assert len([b for b in first if first[b] != second[b]]) == 1 and load.loaded_before is False
    assert spark.table("buck_silver.customers").count() == 201
    load, _ = run(D(2024, 1, 2), [(1001, "other", "MX", "a@b.co", dt.datetime(2024, 1, 2))])
    assert load.loaded_before is True and rows(spark.table("buck_silver.customers").where("customer_id >= 1000"), "customer_id") == [(1001,)]
