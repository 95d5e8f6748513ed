"""Order quality: flags, suites, gate, quarantine, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.functions.numbers import sums_to
from aljibe.functions.text import EMAIL_STRICT
from aljibe.operators.grouping import item_counts
from aljibe.operators.joins import with_group_size, with_key_exists
from aljibe.operators.rules import Rule, accepted, quarantined, with_failed_rules, with_flags
from aljibe.operators.suites import Expectation, audit, between, columns_are, in_set, matches, not_null, require_gate, run_suite, unique
from aljibe.session import stage, staged, unstage
from aljibe.sinks.tables import publish

# Currency of each country, payment methods, order states, segments.
CURRENCY_OF = {"ES": "EUR", "MX": "MXN", "AR": "ARS", "CO": "COP", "CL": "CLP"}
PAYMENT_METHODS = ("CARD", "TRANSFER", "CASH", "PAYPAL")
ORDER_STATES = ("CREATED", "PAID", "CANCELLED", "REFUNDED")
SEGMENTS = ("B2C", "SMB", "ENT")


def order_rules(
    as_of: str,
    currency_of: Mapping[str, str] = CURRENCY_OF,
    payment_methods: Sequence[str] = PAYMENT_METHODS,
    states: Sequence[str] = ORDER_STATES,
) -> list[Rule]:
    """The fourteen order rules, over orders with ``dup_count`` and ``customer_exists``."""
    c = F.col
    pairs = [(c("country") == country) & (c("currency") == currency) for country, currency in currency_of.items()]
    matching: Column = reduce(lambda one, other: one | other, pairs)
    return [
        Rule("order_id_not_null", c("order_id").isNotNull()),
        Rule("order_id_unique", c("dup_count") == 1),
        Rule("customer_id_not_null", c("customer_id").isNotNull()),
        Rule("customer_exists", c("customer_exists")),
        Rule("country_valid", c("country").isin(*currency_of)),
        Rule("currency_valid", c("currency").isin(*currency_of.values())),
        Rule("currency_matches_country", matching),
        Rule("quantity_range", c("quantity").between(1, 100)),
        Rule("unit_price_range", c("unit_price").between(0.01, 10000)),
        Rule("total_matches", sums_to(c("order_total"), c("quantity"), c("unit_price"))),
        Rule("payment_method_valid", c("payment_method").isin(*payment_methods)),
        Rule("order_status_valid", c("order_status").isin(*states)),
        Rule("email_valid", c("email").rlike(EMAIL_STRICT)),
        Rule("order_ts_not_future", c("order_ts") <= F.lit(as_of).cast("timestamp_ntz")),
    ]


def flagged_orders(
    orders: DataFrame, customers: DataFrame, rules: Sequence[Rule], customer_key: str = "customer_id", keys_from: DataFrame | None = None
) -> DataFrame:
    """Orders with duplicate count, customer check, one flag per rule, failed rules and verdict.

    ``keys_from`` may name a frame with the same order and customer ids that is
    cheaper to scan than ``orders``, such as the table they were derived from.
    """
    keys = orders if keys_from is None else keys_from
    counted = with_group_size(orders, ["order_id"], "dup_count", keys_from=keys)
    known = with_key_exists(counted, "customer_id", customers, customer_key, "customer_exists", keys_from=keys)
    return with_failed_rules(with_flags(known, rules), rules)


def customer_suite(as_of: str) -> list[Expectation]:
    return [
        columns_are("customer_id", "signup_date", "country", "segment", "email"),
        not_null("customer_id"),
        unique("customer_id"),
        in_set("country", *CURRENCY_OF),
        in_set("segment", *SEGMENTS),
        matches("email", EMAIL_STRICT, mostly=0.90),
        between("signup_date", "2022-01-01", as_of),
    ]


def order_suite(
    as_of: str,
    countries: Sequence[str] = tuple(CURRENCY_OF),
    currencies: Sequence[str] = tuple(CURRENCY_OF.values()),
    payment_methods: Sequence[str] = PAYMENT_METHODS,
    states: Sequence[str] = ORDER_STATES,
    first_day: str = "2022-01-01",
) -> list[Expectation]:
    return [
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        in_set("country", *countries),
        in_set("currency", *currencies),
        between("quantity", 1, 100),
        between("unit_price", 0.01, 10000),
        between("order_total", 0.01, 1000000),
        in_set("payment_method", *payment_methods),
        in_set("order_status", *states),
        matches("email", EMAIL_STRICT, mostly=0.99),
        between("order_ts", first_day, as_of),
    ]


def key_suite() -> list[Expectation]:
    return [in_set("customer_exists", True)]


def validated(orders: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Results of the customer, order and key suites."""
    keys = with_key_exists(orders, "customer_id", customers, "customer_id", "customer_exists")
    return (
        run_suite(customers, customer_suite(as_of), "customers_suite")
        .unionByName(run_suite(orders, order_suite(as_of), "orders_suite"))
        .unionByName(run_suite(keys.select("customer_exists"), key_suite(), "orders_fk_suite"))
    )


def run_quality(orders: DataFrame, customers: DataFrame, as_of: str, schema: str, enforce: bool = False) -> dict[str, str]:
    """Validate, check the gate, split into silver and quarantine, write audit and rule frequency.

    The flagged orders are computed once, written apart by verdict, and silver and quarantine are read back from their part.
    Returns the tables written.
    """
    results = staged(validated(orders, customers, as_of))
    tables = {name: f"{schema}.{name}" for name in ("dq_results", "dq_validation_audit", "orders_silver", "orders_quarantine", "rule_frequency")}
    publish(results, tables["dq_results"])
    publish(audit(results), tables["dq_validation_audit"])
    if enforce:
        require_gate(results)
    flagged = flagged_orders(orders, customers, order_rules(as_of))
    spark = orders.sparkSession
    path = stage(flagged, "is_valid")
    try:
        apart = spark.read.schema(flagged.schema).parquet(path)
        publish(accepted(apart, orders.columns), tables["orders_silver"])
        publish(quarantined(apart).select(*flagged.columns), tables["orders_quarantine"])
    finally:
        unstage(spark, path)
    written = spark.table(tables["orders_quarantine"])
    publish(item_counts(written, "failed_rules", "failed_rule"), tables["rule_frequency"])
    return tables
