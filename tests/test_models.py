import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aljibe.operators import anomalies, documents, models, opslog
from aljibe.plans import retail, schedule

D = dt.date


def test_segment_boundaries(spark):
    signup = F.lit("2024-01-31").cast("date")
    days = [D(2024, 1, 31), D(2024, 3, 1), D(2024, 3, 2), D(2024, 1, 26)]
    got = spark.range(1).select(*[models.customer_segment(F.lit(d), signup) for d in days], models.customer_segment(F.lit(days[0]), F.lit(None).cast("date")))
    assert tuple(got.first()) == ("new", "new", "existing", "new", "existing")


def test_daily_and_country_sales(spark, rows):
    orders = spark.createDataFrame(
        [(1, 10, D(2024, 1, 1), 10.0), (2, 10, D(2024, 1, 1), 5.555), (3, 99, D(2024, 1, 1), 7.0), (4, None, D(2024, 1, 2), 1.0), (None, 11, D(2024, 1, 2), 2.0), (6, 11, None, 3.0)],
        "order_id int, customer_id int, order_date date, amount double",
    )
    customers = spark.createDataFrame([(10, "ES"), (11, None)], "customer_id int, country string")
    assert rows(models.daily_sales(orders)) == [(D(2024, 1, 1), 3, 22.56, 7.52), (D(2024, 1, 2), 1, 3.0, 1.5)]
    assert rows(models.sales_by_country(orders, customers)) == [(D(2024, 1, 1), "ES", 2, 15.56)]


def test_paid_sales_keep_null_groups(spark, rows):
    sales = spark.createDataFrame(
        [(D(2024, 1, 1), "ES", None, "paid", 2, None, 1), (D(2024, 1, 1), "ES", None, "paid", 1, 4.0, 1), (D(2024, 1, 1), "ES", "home", "pending", 1, 9.0, 2)],
        "order_date date, country string, category string, status string, quantity int, gross_amount double, customer_id int",
    )
    assert rows(models.paid_sales_by_day(sales, "paid")) == [(D(2024, 1, 1), "ES", None, 2, 3, 4.0, 4.0)]
    assert rows(models.customer_lifetime(sales, "paid")) == [(1, "ES", 2, 4.0, D(2024, 1, 1))]


def test_revenue_drop(spark, rows):
    revenue = [100.0, 100.0, 50.0, 59.0, 200.0, 100.0, 100.0, 100.0, 100.0, 60.0, 10.0]
    days = [D(2024, 1, 1 + 2 * i) for i in range(len(revenue))]
    daily = spark.createDataFrame(list(zip(days, revenue)), "order_date date, total_revenue double")
    got = [r["run_date"] for r in anomalies.revenue_drops(daily).collect()]
    expected = [
        days[i] for i in range(len(revenue))
        if len(revenue[max(0, i - 7):i]) >= 3 and revenue[i] / (sum(revenue[max(0, i - 7):i]) / len(revenue[max(0, i - 7):i])) < 0.6
    ]
    assert got == expected and days[2] not in got and days[-1] in got
    assert rows(anomalies.revenue_drop_on(daily, days[-1])) == [(days[-1], 10.0, 102.71, 0.0974)]
    assert anomalies.revenue_drop_on(daily, D(2030, 1, 1)).count() == 0
    alert = anomalies.drop_alerts(anomalies.revenue_drop_on(daily, days[-1]), "r1", dt.datetime(2024, 2, 1)).first()
    assert alert["alert_type"] == "REVENUE_DROP" and "0.0974" in alert["message"]


def test_run_summary_and_versions(spark, rows):
    t = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    events = [
        opslog.log_rows(spark, opslog.EVENTS, [dict(event_ts=t[1], run_id="r", stage="s", status="OK", level="INFO", rows_ok=5, extra={"a": 1})]),
        opslog.log_rows(spark, opslog.EVENTS, [dict(event_ts=t[0], run_id="r", stage="s", status="STARTED", level="INFO")]),
        opslog.log_rows(spark, opslog.EVENTS, [dict(event_ts=t[2], run_id="r", stage="g", dataset="d", message="boom", status="FAILED", level="ERROR")]),
    ]
    log = events[0].unionByName(events[1]).unionByName(events[2])
    assert rows(opslog.run_summary(log)) == [("r", "g", t[2], t[2], "FAILED", 1, 0, 0, 1), ("r", "s", t[0], t[1], "OK", 2, 5, 0, 0)]
    assert events[0].first()["extra"] == '{"a": 1}'
    assert rows(anomalies.failure_alerts(log)) == [(t[2], "r", "PIPELINE_FAILURE", "HIGH", "[g/d] boom")]
    with pytest.raises(ValueError):
        opslog.log_rows(spark, opslog.EVENTS, [dict(nope=1)])
    versions = [opslog.log_rows(spark, opslog.VERSIONS, [dict(table_name="t", version=v, num_output_rows=str(v))]) for v in (0, 2, 1)]
    assert rows(opslog.latest_versions(versions[0].union(versions[1]).union(versions[2])), "version") == [(2,)]


def test_retail_layers(spark, tmp_path, rows):
    orders = spark.createDataFrame(
        [(1, 1, 1, 2, dt.datetime(2024, 1, 20), "paid"), (2, 1, 9, 1, dt.datetime(2024, 1, 20), "paid"), (3, 2, 1, 0, dt.datetime(2024, 1, 20), "paid")],
        "order_id bigint, customer_id bigint, product_id bigint, quantity bigint, order_ts timestamp, status string",
    )
    customers = spark.createDataFrame([(1, "ES", D(2024, 1, 1))], "customer_id bigint, country string, signup_date date")
    products = spark.createDataFrame([(1, "home", 2.345, True), (9, "books", 5.0, False)], "product_id bigint, category string, unit_price double, active boolean")
    payments = spark.createDataFrame([(7, 1, 4.69, "EUR", "card", dt.datetime(2024, 1, 21))],
                                     "payment_id bigint, order_id bigint, amount double, currency string, payment_method string, paid_at timestamp")
    for name, df in (("orders", orders), ("customers", customers), ("products", products), ("payments", payments)):
        from aljibe.sinks.files import write_layer
        write_layer(df, str(tmp_path / "bronze"), name, "2024-02-01")
    retail.publish_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "2024-02-01")
    silver = spark.read.parquet(str(tmp_path / "silver/orders"))
    assert rows(silver, "order_id", "category", "customer_segment", "gross_amount", "payment_id") == [(1, "home", "new", 4.69, 7), (2, None, "new", None, None)]
    retail.publish_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), "2024-02-01")
    assert rows(spark.read.parquet(str(tmp_path / "gold/customer_ltv")), "customer_id", "paid_orders", "lifetime_value") == [(1, 1, 4.69)]
    assert spark.read.parquet(str(tmp_path / "gold/agg_daily_sales")).count() == 1  # the order of a product that is not active is left out


def episode(id_, show, network=None, channel=None, airdate="2024-01-05", airstamp=None, genres=("Drama",)):
    def place(origin):
        return origin and {"id": origin[0], "name": origin[1], "country": {"name": "Spain", "code": "ES", "timezone": "x"}}

    return {
        "id": id_, "name": f"e{id_}", "season": 1, "number": 1.0, "type": "regular", "airdate": airdate, "airstamp": airstamp, "runtime": 30.0,
        "rating": {"average": 7.5}, "_embedded": {"show": {
            "id": show, "name": f"s{show}", "genres": list(genres), "schedule": {"time": "20:00", "days": ["Monday", "Friday"]},
            "rating": {"average": 8.0}, "network": place(network), "webChannel": place(channel)}},
    }


ORIGIN = "struct<id:bigint,name:string,country:struct<name:string,code:string,timezone:string>>"
EPISODE = (
    "id bigint, name string, season bigint, number double, type string, airdate string, airstamp string, runtime double, rating struct<average:double>, "
    "_embedded struct<show:struct<id:bigint,name:string,genres:array<string>,schedule:struct<time:string,days:array<string>>,"
    f"rating:struct<average:double>,network:{ORIGIN},webChannel:{ORIGIN}>>"
)


def test_schedule_from_nested_json_to_gold(spark, tmp_path, rows):
    one = episode(1, 10, network=(5, "Five"))
    days = {
        "2024/01/05": [one, one, episode(2, 11, channel=(5, "Web five"), airdate="", airstamp="2024-01-06T01:00:00+00:00", genres=())],
        "2024/01/06": [episode(3, 10, network=(5, "Five"), channel=(8, "Web eight"), airdate="2024-01-06"), episode(4, 12, airdate="bad")],
    }
    for day, episodes in days.items():
        (tmp_path / day).mkdir(parents=True)
        (tmp_path / day / "day.json").write_text(json.dumps(episodes))
    silver = schedule.silver(schedule.bronze(spark, str(tmp_path), EPISODE)).cache()
    assert silver.count() == 4
    assert rows(silver.where("episode_id < 3"), "episode_id", "episode_rating", "show_genres", "show_schedule_days", "show_webchannel_id") == [
        (1, 7.5, "Drama", "Monday,Friday", None), (2, 7.5, "", "Monday,Friday", 5)]
    assert rows(schedule.dim_networks(silver)) == [(5, "Five", "ES", "Spain", "broadcast"), (8, "Web eight", "ES", "Spain", "web")]
    assert rows(schedule.dim_shows(silver), "show_id", "show_language", "show_network_name") == [(10, None, "Five"), (11, None, None), (12, None, None)]
    assert rows(schedule.dim_dates(silver), "date_key", "is_weekend") == [(20240105, False), (20240106, True)]
    assert rows(schedule.fact_episodes(silver), "episode_id", "date_key", "network_id") == [
        (1, 20240105, 5), (2, 20240106, 5), (3, 20240106, 5), (4, None, None)]


PAGE = """<html><head><title>
 All &amp; more</title></head><body>
<article class="product_pod"><h3><a href="a.html" title="A &quot;Light&quot;">A</a></h3>
  <p class="price_color">£51.77</p><p class="instock availability"><i class="icon-ok"></i>
    In stock
  </p></article>
<article class="product_pod"><h3><a href="b.html" title="B">B</a></h3>
  <p class="price_color">free</p><p class="availability">Sold out</p></article>
<article id="x" class='wide product_pod'><h3><a title='C "quoted"' href='c.html'>C</a></h3>
  <p class='big price_color'>£3.50</p><p data-n="1" class='availability instock'>In stock</p></article>
<article class="product_podcast"><h3><a href="d.html" title="D">D</a></h3></article>
</body></html>"""


def test_pages(spark, rows):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>no items</p>")], "page_id int, html string")
    assert rows(documents.listed_products(pages)) == [
        ('A "Light"', 51.77, "GBP", True, "books_to_scrape"), ("B", None, "GBP", False, "books_to_scrape"),
        ('C "quoted"', 3.5, "GBP", True, "books_to_scrape")]
    assert rows(documents.page_links(pages, "page_id", "html")) == [(1, 0, "a.html"), (1, 1, "b.html"), (1, 2, "c.html"), (1, 3, "d.html")]
    assert [r[0] for r in pages.select(documents.page_title(F.col("html"))).collect()] == ["\n All & more", None, ""]


def test_messages(spark, rows):
    docs = spark.createDataFrame([(1, '{"transcript": [{"role": "user", "text": "hi"}, {"role": "agent", "text": "yo"}]}'), (2, "{}")], "id int, doc string")
    assert rows(documents.messages(docs, ["id"], "doc", "struct<role:string,text:string>")) == [(1, "agent", "yo"), (1, "user", "hi")]
