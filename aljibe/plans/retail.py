"""Retail sales: orders, customers, products and payments to silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from aljibe.errors import DataQualityError
from aljibe.functions.numbers import rounded
from aljibe.operators.columns import typed
from aljibe.operators.contracts import Contract, Field, check_contract
from aljibe.operators.models import customer_lifetime, customer_segment, paid_sales_by_day
from aljibe.operators.partials import lifetime_of, sale_states
from aljibe.operators.rules import Rule
from aljibe.sinks.files import write_layer
from aljibe.sources.files import read_layer

# Accepted countries, categories, segments and states.
COUNTRIES = ("ES", "MX", "CO", "AR", "CL")
CATEGORIES = ("electronics", "fashion", "home", "sports", "books")
SEGMENTS = ("new", "existing")
STATES = ("paid", "cancelled", "pending")


# The bronze columns silver reads, with the types they are cast to.
ORDERS = "order_id bigint, customer_id bigint, product_id bigint, quantity bigint, order_ts timestamp, status string"
CUSTOMERS = "customer_id bigint, country string, signup_date date"
PRODUCTS = "product_id bigint, category string, unit_price double, active boolean"
PAYMENTS = "payment_id bigint, order_id bigint, amount double, currency string, payment_method string, paid_at timestamp"


def silver_orders(orders: DataFrame, customers: DataFrame, products: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their customer, active product and payment, gross amount and customer segment.

    Values that do not fit the declared types raise an error.
    """
    order_day = F.to_date("order_ts")
    # The columns of silver orders, in order.
    return (
        typed(orders, StructType.fromDDL(ORDERS)).where(F.col("quantity") > 0)
        .join(typed(customers, StructType.fromDDL(CUSTOMERS)), "customer_id", "left")
        .join(typed(products, StructType.fromDDL(PRODUCTS)).where("active").drop("active"), "product_id", "left")
        .join(typed(payments, StructType.fromDDL(PAYMENTS)), "order_id", "left")
        .select(
            "order_id", order_day.alias("order_date"), "order_ts", "customer_id", "product_id", "country", "category",
            customer_segment(order_day, F.col("signup_date")).alias("customer_segment"),
            "quantity", "unit_price", rounded(F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
            "status", "payment_id", "amount", "currency", "payment_method", "paid_at",
        )
    )


def silver_contract() -> Contract:
    def at_least(column: str, low: float) -> tuple[Rule, ...]:
        return (Rule(f"at least {low}", F.col(column) >= low),)

    def one_of(column: str, values: tuple[str, ...]) -> tuple[Rule, ...]:
        return (Rule("allowed value", F.col(column).isin(*values)),)

    gross: Column = rounded(F.col("gross_amount")) == rounded(F.col("quantity") * F.col("unit_price"))
    return Contract(
        fields=(
            Field("order_id", "bigint", unique=True),
            Field("customer_id", "bigint"),
            Field("product_id", "bigint"),
            Field("country", "string", checks=one_of("country", COUNTRIES)),
            Field("category", "string", checks=one_of("category", CATEGORIES)),
            Field("customer_segment", "string", checks=one_of("customer_segment", SEGMENTS)),
            Field("quantity", "bigint", checks=(Rule("above 0", F.col("quantity") > 0),)),
            Field("unit_price", "double", checks=at_least("unit_price", 0)),
            Field("gross_amount", "double", checks=at_least("gross_amount", 0)),
            Field("status", "string", checks=one_of("status", STATES)),
            Field("amount", "double", nullable=True, checks=at_least("amount", 0)),
        ),
        cross_checks=(Rule("gross_amount is quantity * unit_price", gross),),
    )


def order_contract() -> Contract:
    """Contract of raw order lines before they are ingested."""
    return Contract(fields=(
        Field("order_id", "bigint"),
        Field("customer_id", "bigint"),
        Field("product_id", "bigint"),
        Field("quantity", "bigint", checks=(Rule("above 0", F.col("quantity") > 0),)),
        Field("order_ts", "timestamp"),
        Field("status", "string", checks=(Rule("allowed value", F.col("status").isin(*STATES)),)),
    ))


def publish_silver(spark, bronze: str, silver: str, run_date: str) -> str:
    """Read one run date of the four bronze datasets, write silver orders."""
    parts = {name: read_layer(spark, bronze, name, run_date) for name in ("orders", "customers", "products", "payments")}
    return write_layer(silver_orders(**parts), silver, "orders", run_date)


def complete_sales(silver: DataFrame) -> DataFrame:
    """Silver orders whose product is known: those with a category and a price."""
    return silver.where(F.col("category").isNotNull() & F.col("unit_price").isNotNull())


def publish_gold(spark, silver: str, gold: str, run_date: str, contract: Contract | None = None) -> None:
    """Check the silver orders of one run date against their contract, then write fact_sales, agg_daily_sales, customer_ltv and customer_ltv_states.

    ``customer_ltv`` is that of the run date's orders; ``customer_ltv_states`` keeps their partial sums, from which ``lifetime`` takes that of all run dates.

    Orders without category or price are left out first. Raises DataQualityError, naming the broken checks, before
    anything is written.
    """
    sales = complete_sales(read_layer(spark, silver, "orders", run_date).drop("run_date"))
    failures = check_contract(sales, contract or silver_contract(), ["order_id"])
    broken = failures.groupBy("column", "check").count().orderBy("column", "check").collect()
    if broken:
        raise DataQualityError("silver orders break their contract: " + "; ".join(f"{r[0]} {r[1]} ({r[2]} rows)" for r in broken))
    write_layer(sales, gold, "fact_sales", run_date)
    write_layer(paid_sales_by_day(sales, "paid"), gold, "agg_daily_sales", run_date)
    write_layer(customer_lifetime(sales, "paid"), gold, "customer_ltv", run_date)
    write_layer(sale_states(sales, "paid", "order_date"), gold, "customer_ltv_states", run_date)


def lifetime(spark, gold: str, upto: str | None = None) -> DataFrame:
    """Lifetime value over all run dates, or those up to ``upto``, where each run date brings orders of its own. A run date that was published again counts once.

    Sums of a few numbers per customer, country, order date and run date are read, no orders.
    """
    states = read_layer(spark, gold, "customer_ltv_states")
    return lifetime_of(states if upto is None else states.where(F.col("run_date") <= upto))
