import datetime as dt

from pyspark.sql import functions as F

from aljibe.functions import dates, nested, numbers, text


def one(spark, *values):
    return tuple(spark.range(1).select(*values).first())


def test_rounding_is_half_up_on_decimals(spark):
    assert one(spark, *[numbers.rounded(F.lit(x)) for x in (1.005, 0.125, -0.125, 2.675)]) == (1.01, 0.13, -0.13, 2.68)


def test_money(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, v double")
    got = {r["k"]: (r["t"], r["m"]) for r in df.groupBy("k").agg(
        numbers.money_total(F.col("v")).alias("t"), numbers.money_mean(F.col("v")).alias("m")).collect()}
    assert got == {"a": (0.3, 0.15), "b": (0.0, None)}


def test_coercion_and_shares(spark):
    assert one(spark, *[numbers.coerced(F.lit(x), "double") for x in ("10", "error", "nan", None)]) == (10.0, None, None, None)
    assert one(spark, numbers.share(F.lit(1), F.lit(4)), numbers.share(F.lit(0), F.lit(0)), numbers.percent(F.lit(1), F.lit(3))) == (0.25, 0.0, 33.33)
    df = spark.createDataFrame([(x,) for x in ("10", "20", "error", "30")], "v string")
    assert df.agg(F.sum(numbers.coerced(F.col("v"), "double"))).first()[0] == 60.0


def test_total_consistency(spark):
    assert one(spark, *[numbers.sums_to(F.lit(t), F.lit(3), F.lit(1.1)) for t in (3.3, 3.305, 3.31, None)]) == (True, True, False, None)


def test_text(spark):
    assert [text.tidy_name(n) for n in (" Rating.Average ", "web-Channel id", "a b.c")] == ["rating_average", "web_channel_id", "a_b_c"]
    assert one(spark, *[text.normalized(F.lit(x)) for x in (" Ana ", "luis", "\tSOFIA \n", None)]) == ("ana", "luis", "sofia", None)
    assert one(spark, text.without_accents(F.lit("bogotá medellín ñu"))) == ("bogota medellin nu",)
    city = {"bogotá": "bogota", "medellín": "medellin"}
    assert one(spark, *[text.recoded(F.lit(x).cast("string"), city) for x in ("bogotá", "cali", None)]) == ("bogota", "cali", None)
    assert one(spark, *[text.first_number(F.lit(x)) for x in ("£51.77", "no price", "1.2.3", "7 of 9")]) == (51.77, None, None, 7.0)
    assert one(spark, text.mentions(F.lit("IN STOCK (3)"), "In stock"), text.mentions(F.lit("sold out"), "in stock")) == (True, False)
    assert one(spark, *[text.is_email(F.lit(x)) for x in ("a@b.co", "a@b", "a b@c.d", None)]) == (True, False, False, False)
    assert one(spark, text.plain_markup(F.lit("a &lt;b&gt; &quot;c&quot; &#39;d&#39; &amp;lt;"))) == ("a <b> \"c\" 'd' &lt;",)


def test_dates(spark):
    assert one(spark, *[dates.parsed_date(F.lit(x)) for x in ("2024-01-05", "2024-01-05 22:10:00", "", "soon", "2024-01-05T22:00:00+00:00")]) == (
        dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, dt.date(2024, 1, 5))
    day = F.lit("2021-01-03").cast("date")
    got = spark.range(1).select(*[c.alias(n) for n, c in dates.calendar(day).items()]).first().asDict()
    assert got == {
        "date_key": 20210103, "date": dt.date(2021, 1, 3), "year": 2021, "quarter": 1, "month": 1, "month_name": "January",
        "day": 3, "day_name": "Sunday", "week_of_year": 53, "is_weekend": True,
    }
    moments = ("2024-03-01 04:59:59", "2024-03-01 05:00:00")
    assert one(spark, *[dates.yesterday(F.lit(m).cast("timestamp")) for m in moments]) == (dt.date(2024, 2, 28), dt.date(2024, 2, 29))


def test_nested(spark):
    assert one(spark, nested.joined(F.array(F.lit("a"), F.lit(None), F.lit("b"))), nested.joined(F.array().cast("array<string>"))) == ("a,b", "")
    first = F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))
    second = F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(1))
    assert one(spark, nested.comparable_map(first) == nested.comparable_map(second)) == (True,)
    assert one(spark, nested.map_total(first), nested.array_mean(F.map_values(first)), nested.array_mean(F.array().cast("array<int>"))) == (3.0, 1.5, None)
    numbers_ = F.sequence(F.lit(1), F.lit(5))
    total = nested.mapped_filtered_reduced(numbers_, lambda x: x * 2, lambda x: x > 4, lambda a, x: a + x, F.lit(0))
    assert one(spark, total) == (24,)


def test_first_list_skips_keys_that_hold_no_list(spark):
    docs = [
        '{"messages": "none", "transcript": [{"m": "t"}], "turns": [{"m": "x"}]}', '{"turns": [{"m": "u"}]}', '{"other": []}', "broken",
    ]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    found = [r[0] for r in df.select(nested.first_list(F.col("d"), "struct<m:string>")).collect()]
    assert [f and [x["m"] for x in f] for f in found] == [["t"], ["u"], None, None]
