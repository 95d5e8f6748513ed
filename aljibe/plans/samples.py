"""The sample tables in the roles of the pipelines, with planted defects.

The sample tables are clean. ``dirty_orders`` and ``checked_orders`` give every
order a place in a pattern of defects by its key, so that each rule has rows to
find at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2001-06-01"

# The currency of each region, which plays the country.
CURRENCY_OF = {"AFRICA": "ZAR", "AMERICA": "USD", "ASIA": "CNY", "EUROPE": "EUR", "MIDDLE EAST": "SAR"}
STATUSES = ("P", "O", "F")
PAYMENT_METHODS = ("CARD", "TRANSFER", "CASH", "PAYPAL")


# The columns of the sample tables. Declared, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with missing, duplicate, orphan and negative values."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.when(_every(97), None).when(_every(89), F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("order_id"),
        F.when(_every(53), None).when(_every(61), F.lit(-1)).otherwise(F.col("o_custkey")).cast("bigint").alias("customer_id"),
        F.when(_every(71), None).when(_every(66), F.lit(-10.0)).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(~_every(101), F.col("o_orderdate").cast("date")).alias("order_date"),
        F.when(_every(79), "zz").otherwise(F.col("o_orderstatus")).alias("status"),
    )


def checked_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with country, currency, payment and e-mail, and a defect for each rule."""
    regions = (
        table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    customers = (
        table(spark, folder, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "r_name")
    )
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price = (F.col("o_custkey") % 500 + 1).cast("double")
    quantity = (F.col("o_orderkey") % 5 + 1).cast("int")
    currency = F.create_map(*[F.lit(x) for pair in CURRENCY_OF.items() for x in pair])[F.col("r_name")]
    method = F.element_at(F.array(*[F.lit(m) for m in PAYMENT_METHODS]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.when(_every(97), None).when(_every(89), F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("order_id"),
        F.when(_every(53), None).when(_every(61), F.lit(-1)).otherwise(F.col("o_custkey")).cast("bigint").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.when(_every(83), "ZZ").otherwise(F.col("r_name")).alias("country"),
        F.when(_every(59), "XXX").otherwise(currency).alias("currency"),
        F.when(_every(67), F.lit(-3)).otherwise(quantity).alias("quantity"),
        F.when(_every(103), F.lit(0.0)).otherwise(price).alias("unit_price"),
        (quantity * price + F.when(_every(73), F.lit(10.0)).otherwise(F.lit(0.0))).alias("order_total"),
        F.when(_every(107), "BARTER").otherwise(method).alias("payment_method"),
        F.when(_every(79), "zz").otherwise(F.col("o_orderstatus")).alias("order_status"),
        F.when(_every(79), "bad-email").otherwise(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@demo.com"))
        ).alias("email"),
    )


def sales_lines_base(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with customer country and category of active products.

    Customers are joined to the orders, not to the several times larger lines.
    """
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    products = table(spark, folder, "part").where(F.col("p_size") > 5).select("p_partkey", "p_type", "p_retailprice")
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_quantity") > 0)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(products, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
