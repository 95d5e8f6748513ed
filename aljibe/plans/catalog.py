"""Registered queries: every operator over the whole sample tables.

Each takes the session and the folder of the tables and returns a lazy frame.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from aljibe.functions import dates, nested, numbers, text
from aljibe.operators import anomalies, cleaning, columns, contracts, documents, grouping, joins, models, opslog, partials, profile, rejects, rules, suites, variants
from aljibe.plans import quality, retail
from aljibe.plans.samples import (
    AS_OF, CURRENCY_OF, PAYMENT_METHODS, STATUSES, checked_orders, dirty_orders, sales_lines_base, table,
)
from aljibe.sinks.changes import replaced_range, upserted
from aljibe.sources.gaps import missing_ranges
from aljibe.sources.jdbc import read_increment
from aljibe.streaming.lines import sales_lines, squares_of_multiples

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _day(column: str) -> Column:
    return F.col(column).cast("date")


# sales ---------------------------------------------------------------------


@query
def gold_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return models.daily_sales(rejects.valid_orders(dirty_orders(spark, folder)))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), "country"
    )


@query
def sales_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return models.sales_by_country(rejects.valid_orders(dirty_orders(spark, folder)), _customers(spark, folder))


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    gross = numbers.rounded(F.col("l_quantity") * F.col("p_retailprice"))
    return sales_lines_base(spark, folder).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), _day("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"), F.col("n_name").alias("country"),
        F.col("p_type").alias("category"), F.col("l_quantity").alias("quantity"), F.col("p_retailprice").alias("unit_price"),
        gross.alias("gross_amount"), F.col("o_orderstatus").alias("status"),
    )


@query
def silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder)


@query
def agg_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return models.paid_sales_by_day(_sales(spark, folder), "F")


@query
def customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    return models.customer_lifetime(_sales(spark, folder), "F")


@query
def customer_ltv_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Lifetime value from the partial states of each order date."""
    return partials.lifetime_of(partials.sale_states(_sales(spark, folder), "F", "order_date"))


@query
def customer_segment(spark: SparkSession, folder: str) -> DataFrame:
    signup = F.when(F.col("o_custkey") % 50 != 0, F.date_add(F.lit("1998-01-01").cast("date"), (F.col("o_custkey") % 400).cast("int")))
    return table(spark, folder, "orders").select(
        "o_orderkey", models.customer_segment(_day("o_orderdate"), signup).alias("segment")
    )


@query
def net_revenue(spark: SparkSession, folder: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.rounded(net, 4).alias("net"), numbers.rounded(net * (1 + F.col("l_tax")), 4).alias("taxed")
    )


@query
def approved_by_group(spark: SparkSession, folder: str) -> DataFrame:
    approved = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return grouping.total_by(approved, ["o_orderpriority"], "o_totalprice", "total").orderBy(F.desc("total"))


@query
def partial_final_sum(spark: SparkSession, folder: str) -> DataFrame:
    approved = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    partials = grouping.partial_totals(approved, ["o_orderpriority"], "o_totalprice", F.col("o_orderkey") % 8)
    return grouping.merged_totals(partials, ["o_orderpriority"], "total")


@query
def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.table_stats(table(spark, folder, "orders"), "o_totalprice")


@query
def product_agg(spark: SparkSession, folder: str) -> DataFrame:
    """Product of each order's line numbers."""
    return grouping.product_by(table(spark, folder, "lineitem"), ["l_orderkey"], F.col("l_linenumber"), "product")


@query
def top_values(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.top_values(rejects.with_reject_reason(dirty_orders(spark, folder)), "reject_reason", 5)


def _revenue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy(_day("o_orderdate").alias("order_date")).agg(
        numbers.money_total(F.col("o_totalprice")).alias("total_revenue")
    )


@query
def revenue_drop(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.revenue_drops(_revenue(spark, folder))


@query
def drop_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = anomalies.drop_alerts(anomalies.revenue_drops(_revenue(spark, folder)), "run-1", datetime(2024, 2, 1))
    return alerts.drop("alert_ts")


def _pipeline_events(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, folder, "events").select(
        F.col("ts").alias("event_ts"), F.when(failed, "ERROR").otherwise("INFO").alias("level"),
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.lit("events").alias("dataset"),
        F.when(failed, "FAILED").when(F.col("value") > 30, "STARTED").otherwise("OK").alias("status"),
        F.col("props").alias("message"), F.floor("value").alias("rows_ok"), F.when(failed, F.lit(1)).cast("bigint").alias("rows_reject"),
    )


@query
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return opslog.run_summary(_pipeline_events(spark, folder))


@query
def failure_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.failure_alerts(_pipeline_events(spark, folder))


# rejects and contracts -----------------------------------------------------


@query
def reject_reason(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.reason_counts(dirty_orders(spark, folder))


@query
def valid_orders(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.valid_orders(dirty_orders(spark, folder))


@query
def reject_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.reject_rate(dirty_orders(spark, folder))


def _contract() -> contracts.Contract:
    one_of = "allowed value"
    return contracts.Contract(
        fields=(
            contracts.Field("order_id", "bigint", unique=True),
            contracts.Field("customer_id", "bigint"),
            contracts.Field("currency", "string", checks=(rules.Rule(one_of, F.col("currency").isin(*CURRENCY_OF.values())),)),
            contracts.Field("quantity", "int", checks=(rules.Rule("above 0", F.col("quantity") > 0),)),
            contracts.Field("order_status", "string", checks=(rules.Rule(one_of, F.col("order_status").isin(*STATUSES)),)),
        ),
        cross_checks=(
            rules.Rule("total is quantity * price", numbers.sums_to(F.col("order_total"), F.col("quantity"), F.col("unit_price"))),
        ),
    )


@query
def contract_failures(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.check_contract(checked_orders(spark, folder), _contract(), ["order_key"], keys_from=dirty_orders(spark, folder))


@query
def contract_orders(spark: SparkSession, folder: str) -> DataFrame:
    row_contract = contracts.Contract(fields=tuple(f for f in _contract().fields if f.name != "currency"))
    return contracts.broken_rows(checked_orders(spark, folder), row_contract, ["order_key"])


@query
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    expected = StructType([
        StructField("order_id", LongType()), StructField("customer_id", IntegerType()), StructField("amount", DoubleType()),
        StructField("order_date", DateType()), StructField("channel", StringType()),
    ])
    return contracts.schema_drift(dirty_orders(spark, folder).drop("order_key"), expected)


@query
def schema_drift_by_status(spark: SparkSession, folder: str) -> DataFrame:
    expected = StructType([StructField("order_id", LongType()), StructField("customer_id", LongType()), StructField("amount", DoubleType())])
    landed = dirty_orders(spark, folder).select("order_id", "customer_id", "amount", "status")
    return contracts.schema_drift(landed, expected, by="status")


@query
def nested_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Events with nested columns against the types that were agreed on."""
    event = F.col("event_id")
    props = F.struct(
        F.when(event % 4 > 0, F.get_json_object("props", "$.k").cast("int")).alias("k"), F.col("event_type").alias("kind"), F.col("user_id").alias("user"))
    items = F.when(event % 3 > 0, F.array(F.struct(F.col("event_type").alias("name"), F.when(event % 3 == 1, F.col("value")).alias("weight"))))
    landed = table(spark, folder, "events").select("event_id", props.alias("props"), items.alias("items"))
    expected = StructType([
        StructField("event_id", IntegerType()), StructField("note", StringType()),
        StructField("props", StructType([StructField("k", LongType()), StructField("kind", StringType()), StructField("source", StringType())])),
        StructField("items", ArrayType(StructType([StructField("name", StringType()), StructField("weight", FloatType())]))),
    ])
    return contracts.nested_drift(landed, expected)


@query
def retail_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Retail silver from four sources: orders, customers with a signup day, parts as products, payments of finished orders."""
    orders = table(spark, folder, "orders")
    key, nations = F.col("o_orderkey"), table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return retail.silver_orders(
        orders.select(key.alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_custkey").alias("product_id"),
                      (key % 6).alias("quantity"), F.col("o_orderdate").alias("order_ts"), F.col("o_orderstatus").alias("status")),
        table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"), "country", F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("signup_date")),
        table(spark, folder, "part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("unit_price"), (F.col("p_size") > 5).alias("active")),
        orders.where("o_orderstatus = 'F'").select(
            (key * 10).alias("payment_id"), key.alias("order_id"), F.col("o_totalprice").alias("amount"), F.lit("EUR").alias("currency"),
            F.col("o_orderpriority").alias("payment_method"), F.col("o_orderdate").alias("paid_at")),
    ).withColumns({"order_ts": F.col("order_ts").cast("timestamp_ntz"), "paid_at": F.col("paid_at").cast("timestamp_ntz")})


# quality -------------------------------------------------------------------


def _rules() -> list[rules.Rule]:
    return quality.order_rules(AS_OF, CURRENCY_OF, PAYMENT_METHODS, STATUSES)


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return quality.flagged_orders(
        checked_orders(spark, folder), customers, _rules(), "c_custkey", keys_from=dirty_orders(spark, folder)
    )


@query
def dq_flags(spark: SparkSession, folder: str) -> DataFrame:
    flags = [f"rule_{rule.name}" for rule in _rules()]
    return _flagged(spark, folder).select("order_key", *flags, F.size("failed_rules").alias("n_failed"))


@query
def dq_silver(spark: SparkSession, folder: str) -> DataFrame:
    return rules.accepted(_flagged(spark, folder), checked_orders(spark, folder).columns)


@query
def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quarantined(_flagged(spark, folder)).select(
        "order_key", "order_id", "customer_id", "dup_count", nested.joined(F.col("failed_rules")).alias("failed_rules")
    )


@query
def rule_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.item_counts(rules.quarantined(_flagged(spark, folder)), "failed_rules", "failed_rule")


@query
def dq_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return rules.reconciled(_flagged(spark, folder))


@query
def suite_orders(spark: SparkSession, folder: str) -> DataFrame:
    expectations = quality.order_suite(
        AS_OF, tuple(CURRENCY_OF), tuple(CURRENCY_OF.values()), PAYMENT_METHODS, STATUSES, first_day="1995-01-01"
    )
    return suites.run_suite(checked_orders(spark, folder), expectations, "orders_suite", keys_from=dirty_orders(spark, folder))


@query
def suite_customers(spark: SparkSession, folder: str) -> DataFrame:
    expectations = [
        suites.columns_are("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
        suites.not_null("c_custkey"),
        suites.unique("c_custkey"),
        suites.in_set("c_mktsegment", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
        suites.matches("c_name", r"^Customer#[0-9]{9}$", mostly=0.90),
        suites.between("c_acctbal", 0, 9000, mostly=0.80),
    ]
    return suites.run_suite(table(spark, folder, "customer"), expectations, "customers_suite")


@query
def suite_fk(spark: SparkSession, folder: str) -> DataFrame:
    orders = dirty_orders(spark, folder).select("customer_id")
    checked = joins.with_key_exists(orders, "customer_id", table(spark, folder, "customer"), "c_custkey", "customer_exists")
    return suites.run_suite(checked.select("customer_exists"), quality.key_suite(), "orders_fk_suite")


def _all_suites(spark: SparkSession, folder: str) -> DataFrame:
    return suite_customers(spark, folder).unionByName(suite_orders(spark, folder)).unionByName(suite_fk(spark, folder))


@query
def dq_gate(spark: SparkSession, folder: str) -> DataFrame:
    return suites.gate(_all_suites(spark, folder))


@query
def dq_audit(spark: SparkSession, folder: str) -> DataFrame:
    return suites.audit(_all_suites(spark, folder))


@query
def fk_flag(spark: SparkSession, folder: str) -> DataFrame:
    orders = dirty_orders(spark, folder).select("order_key", "customer_id")
    return joins.with_key_exists(orders, "customer_id", table(spark, folder, "customer"), "c_custkey", "customer_exists")


@query
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    orders = dirty_orders(spark, folder).select("order_key", "customer_id", "amount")
    return joins.orphans(orders, "customer_id", table(spark, folder, "customer"), "c_custkey")


def _report_rules(on_null: str) -> list[rules.Rule]:
    c = F.col
    return [
        rules.Rule("quantity_1_to_100", c("quantity").between(1, 100), on_null),
        rules.Rule("price_positive", c("unit_price") > 0, on_null),
        rules.Rule("total_not_negative", c("order_total") >= 0, "pass"),
        rules.Rule("customer_present", c("customer_id") >= 0, on_null),
        rules.Rule("date_not_future", c("order_ts") <= F.lit(AS_OF).cast("timestamp_ntz"), on_null),
        rules.Rule("email_simple", c("email").rlike(text.EMAIL_SIMPLE), on_null),
    ]


def _clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return cleaning.clean(
        checked_orders(spark, folder),
        text=["country", "currency", "payment_method", "order_status"],
        recode={"country": {"middle east": "middle_east", "zz": "unknown"}},
        valid={
            "quantity": c("quantity").between(1, 100),
            "unit_price": c("unit_price") > 0,
            "customer_id": c("customer_id") >= 0,
            "order_ts": c("order_ts") <= F.lit(AS_OF).cast("timestamp_ntz"),
            "email": text.is_email(c("email")),
        },
        recompute={"order_total": numbers.rounded(c("quantity") * c("unit_price"))},
    )


@query
def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _clean_orders(spark, folder).withColumn("order_ts", F.to_date("order_ts"))


@query
def rule_report(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_report(checked_orders(spark, folder), _report_rules("fail"))


@query
def rule_report_clean(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_report(_clean_orders(spark, folder), _report_rules("pass"))


@query
def rule_improvement(spark: SparkSession, folder: str) -> DataFrame:
    return joins.compare_reports(
        rule_report(spark, folder), rule_report_clean(spark, folder), "rule", "pct_invalid", ("_raw", "_clean"), "improvement_points"
    )


@query
def raw_vs_clean(spark: SparkSession, folder: str) -> DataFrame:
    return profile.before_and_after(checked_orders(spark, folder), _clean_orders(spark, folder))


@query
def email_valid(spark: SparkSession, folder: str) -> DataFrame:
    valid = text.is_email(F.col("email"))
    return checked_orders(spark, folder).groupBy(valid.alias("valid")).agg(F.count(F.lit(1)).alias("n"))


# profiles ------------------------------------------------------------------


@query
def profile_missing(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_report(dirty_orders(spark, folder))


@query
def profile_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cardinality_report(dirty_orders(spark, folder))


@query
def profile_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.duplicate_share(table(spark, folder, "lineitem"))


@query
def profile_iqr(spark: SparkSession, folder: str) -> DataFrame:
    return profile.outlier_report(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def profile_describe(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_numbers(table(spark, folder, "part"))


@query
def profile_describe_text(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_text(table(spark, folder, "part"))


@query
def data_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.data_dictionary(dirty_orders(spark, folder), {"amount": "Order value.", "order_date": "Day of the order."})


@query
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    summary_rules = [
        rules.Rule("amount_not_negative", c("amount") >= 0, "fail"),
        rules.Rule("customer_known", c("customer_id") >= 0, "fail"),
        rules.Rule("date_present", c("order_date").isNotNull()),
        rules.Rule("status_valid", c("status").isin(*STATUSES)),
    ]
    return profile.dataset_summary(dirty_orders(spark, folder), summary_rules)


@query
def dup_count(spark: SparkSession, folder: str) -> DataFrame:
    return joins.with_group_size(dirty_orders(spark, folder).select("order_key", "order_id"), ["order_id"], "copies")


@query
def duplicated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return joins.duplicated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.latest_per_key(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


@query
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.dedupe_rows(table(spark, folder, "lineitem"))


# dimensions and facts ------------------------------------------------------


@query
def dim_networks(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers and customers share an id space; a supplier wins a clash."""
    def source(name: str, prefix: str, key: str) -> DataFrame:
        return table(spark, folder, name).select(
            F.col(key).alias("network_id"), F.col(f"{prefix}_name").alias("network_name"), F.col(f"{prefix}_nationkey").alias("country_key")
        )

    return models.dim_from_sources(
        [("broadcast", source("supplier", "s", "s_suppkey")), ("web", source("customer", "c", "c_custkey"))], "network_id", "network_type"
    )


@query
def dim_shows(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a missing key in some rows and a shared key in others."""
    key = F.col("p_partkey")
    shows = table(spark, folder, "part").select(
        F.when(key % 40 == 0, None).when(key % 30 == 1, key + 1).otherwise(key).alias("show_id"),
        F.col("p_name").alias("show_name"), F.col("p_type").alias("show_type"), F.col("p_brand").alias("show_network_name"),
    )
    fixed = StructType([
        StructField("show_id", LongType()), StructField("show_name", StringType()), StructField("show_type", StringType()),
        StructField("show_language", StringType()), StructField("show_network_name", StringType()),
    ])
    return models.dim_by_key(shows, fixed, "show_id", [F.col("show_name"), F.col("show_type"), F.col("show_network_name")])


@query
def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    return models.dim_time(_day("o_orderdate"), table(spark, folder, "orders"))


@query
def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line; date and partner fall back to the line's own.

    Lines are reduced to one per key first: that spreads a large order over its
    line numbers, and what is left is joined to the orders.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", _day("l_shipdate").alias("shipped")
    )
    order = [F.col(c) for c in ("shipped", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    first = grouping.first_per_key(lines, ["l_orderkey", "l_linenumber"], order)
    orders = dirty_orders(spark, folder).select("order_key", "order_date", "customer_id")
    joined = first.join(orders, F.col("l_orderkey") == F.col("order_key"), "left")
    return models.with_fact_keys(
        joined, [F.col("order_date"), F.col("shipped")], [F.col("customer_id"), F.col("l_suppkey")], "partner_id"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "date_key", "partner_id", "l_quantity", "l_extendedprice")


# events, documents, pages --------------------------------------------------


def _parsed_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return columns.tidy_names(columns.flatten(events.withColumn("props", F.from_json("props", "k int"))))


@query
def flatten_props(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed_events(spark, folder).select("event_id", "props_k")


@query
def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    return columns.with_lineage(
        _parsed_events(spark, folder), "events", "events.parquet", "batch-1", "2024-02-01T00:00:00", "2024-02-01"
    )


@query
def silver_events(spark: SparkSession, folder: str) -> DataFrame:
    """Renamed, distinct, with the list column as text."""
    labelled = _parsed_events(spark, folder).withColumn("labels", F.array("event_type", F.concat(F.lit("k"), F.col("props_k"))))
    renamed = columns.rename(labelled, {"event_type": "kind", "props_k": "weight", "not_there": "ignored"}).drop("event_id", "ts")
    return grouping.dedupe_rows(renamed).withColumn("labels", nested.joined(F.col("labels")))


@query
def with_lineage(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return columns.with_lineage(orders, "orders", "orders.parquet", "batch-1", datetime(2024, 2, 1), "2024-02-01")


@query
def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    orders = columns.rename(table(spark, folder, "orders"), {
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "order_date", "o_totalprice": "amount", "o_orderstatus": "status",
    })
    return columns.typed(orders, StructType([
        StructField("order_id", StringType()), StructField("customer_id", IntegerType()), StructField("order_date", DateType()),
        StructField("amount", DoubleType()), StructField("status", StringType()), StructField("source", StringType()),
    ]))


@query
def coerced_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Text fields of the events in declared types; what does not parse is NULL."""
    parts = F.split(F.when(F.col("event_id") % 7 == 0, "n/a,never").otherwise(F.concat_ws(",", "value", F.date_format("ts", "yyyy-MM-dd"))), ",")
    raw = table(spark, folder, "events").select("event_id", parts[0].alias("value"), parts[1].alias("day"))
    schema = StructType([StructField("event_id", LongType()), StructField("value", DoubleType()), StructField("day", DateType())])
    return columns.typed(raw, schema, coerce=True)


@query
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return columns.rename(columns.tidy_names(orders.toDF(" Order.Key", "Cust-Key", "Order Priority ")), {"cust_key": "customer_id", "absent": "x"})


@query
def merged_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns whose tidied names are equal: the first non-NULL value stays."""
    own = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey"))
    orders = table(spark, folder, "orders").select("o_orderkey", own, "o_custkey", "o_orderpriority")
    return columns.tidy_names(orders.toDF("Order Id", "Ref.No", " ref-no ", "Priority"))


@query
def distinct_maps(spark: SparkSession, folder: str) -> DataFrame:
    """Events as maps whose entries come in either order, distinct, as text."""
    kind, weight = (F.lit("kind"), F.col("event_type")), (F.lit("weight"), F.from_json("props", "k string")["k"])
    facts = F.when(F.col("event_id") % 2 == 0, F.create_map(*kind, *weight)).otherwise(F.create_map(*weight, *kind))
    distinct = grouping.dedupe_rows(table(spark, folder, "events").select(facts.alias("facts")))
    pairs = F.transform(nested.comparable_map(F.col("facts")), lambda pair: F.concat_ws("=", pair["key"], pair["value"]))
    return distinct.select(nested.joined(pairs).alias("facts"))


@query
def parsed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days from texts in several forms, NULL where they do not parse."""
    moment, place = F.col("ts"), F.col("event_id") % 4
    written = (
        F.when(place == 0, F.date_format(moment, "yyyy-MM-dd")).when(place == 1, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(place == 2, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon")
    )
    return table(spark, folder, "events").select("event_id", dates.parsed_date(written).alias("day"))


@query
def select_or_null(spark: SparkSession, folder: str) -> DataFrame:
    return columns.select_or_null(table(spark, folder, "orders"), StructType([
        StructField("o_orderkey", LongType()), StructField("o_comment", StringType()), StructField("o_totalprice", DoubleType()),
    ]))


@query
def array_to_text(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array_sort(F.split("p_name", " "))
    return table(spark, folder, "part").select("p_partkey", nested.joined(words).alias("words"))


@query
def amount_band(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", models.amount_band(F.col("o_totalprice"), 150000).alias("band"))


@query
def safe_cast_sum(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 10 == 0, "error").otherwise(F.col("value").cast("string"))
    value = numbers.coerced(raw, "double")
    return table(spark, folder, "events").agg(F.count(value).alias("valid"), numbers.money_total(value).alias("total"))


@query
def hof_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Word lengths of each whole text, doubled, the long ones kept and added up."""
    total = nested.mapped_filtered_reduced(
        F.split("text", " "), lambda word: F.length(word) * 2, lambda size: size > 10, lambda so_far, size: so_far + size, F.lit(0)
    )
    return table(spark, folder, "documents").select("doc_id", total.alias("total"))


@query
def map_sum(spark: SparkSession, folder: str) -> DataFrame:
    parts = F.create_map(
        F.lit("quantity"), F.col("l_quantity"), F.lit("discount"), F.col("l_discount"), F.lit("tax"), F.col("l_tax")
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.rounded(nested.map_total(parts), 4).alias("total"),
        numbers.rounded(nested.array_mean(F.map_values(parts)), 4).alias("mean"),
    )


@query
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    folded = text.without_accents(text.normalized(F.col("text")))
    return table(spark, folder, "documents").select(
        "doc_id",
        text.recoded(text.normalized(F.upper("lang")), {"en": "english", "fr": "french", "de": "german"}).alias("language"),
        F.replace(F.lower("source"), F.lit("src"), F.lit("source ")).alias("source"),
        F.length(folded).alias("n_chars"),
        F.md5(folded).alias("text_md5"),
    )


@query
def extract_number(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", text.first_number(F.col("p_brand")).alias("number"), text.mentions(F.col("p_name"), "Ring").alias("is_ring")
    )


@query
def stream_sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    line = F.when(F.col("event_id") % 10 == 0, "BAD_LINE").otherwise(F.concat_ws(",", "event_id", F.col("value") * 20))
    return sales_lines(table(spark, folder, "events").select(line.alias("value")))


@query
def mult3_squares(spark: SparkSession, folder: str) -> DataFrame:
    return squares_of_multiples(table(spark, folder, "orders"), "o_orderkey")


@query
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", documents.page_title(F.col("html")).alias("title"))


@query
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return documents.page_links(table(spark, folder, "pages"), "page_id", "html")


@query
def page_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each navigation entry as a block with its target and label."""
    return documents.page_items(table(spark, folder, "pages"), ["page_id"], "html", "li", {"target": ("a[href]", "href"), "label": ("a", "text")})


@query
def product_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as entries of listing pages, in either quotes and with other classes beside, and back to products."""
    key, quote = F.col("p_partkey"), F.when(F.col("p_partkey") % 2 == 0, "'").otherwise('"')
    more = F.when(key % 3 == 0, "wide ").otherwise("")
    stock = F.when(key % 5 == 0, "Sold out").otherwise("In stock")
    entry = F.concat(
        F.lit("<article class="), quote, more, F.lit("product_pod"), quote, F.lit("><h3><a href="), quote, key, quote, F.lit(" title="), quote, F.col("p_name"), quote,
        F.lit(">more</a></h3><p class="), quote, F.lit("price_color"), quote, F.lit(">£"), F.format_string("%.2f", "p_retailprice"),
        F.lit("</p><p class="), quote, more, F.lit("availability"), quote, F.lit('><i class="icon"></i> '), stock, F.lit(" </p></article>"),
    )
    return documents.listed_products(table(spark, folder, "part").select("p_partkey", entry.alias("html")), keep=["p_partkey"])


@query
def messages_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as JSON documents of a message and its answer, each under one of the four keys, and back to rows."""
    turns = table(spark, folder, "conversations")
    answer = F.struct("turn", F.lit("answer").alias("role"), F.substring("text", 1, 40).alias("text"))
    items = F.array(F.struct("turn", "role", "text"), answer)
    document = F.to_json(F.struct(*[
        F.when(F.pmod("turn", F.lit(len(nested.MESSAGE_KEYS))) == place, items).alias(key) for place, key in enumerate(nested.MESSAGE_KEYS)
    ]))
    return documents.messages(turns.select("conv_id", document.alias("document")), ["conv_id"], "document", "struct<turn:bigint,role:string,text:string>")


def _loose_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Events with documents that nobody declared: the value as number or text, a list or an object beside it, and every eleventh cut short."""
    event, k = F.col("event_id"), F.get_json_object("props", "$.k")
    value = F.when(event % 5 == 0, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k)
    more = (
        F.when(event % 3 == 0, F.concat(F.lit(', "tags": ["'), F.col("event_type"), F.lit('", {"deep": '), event.cast("string"), F.lit("}]")))
        .when(event % 3 == 1, F.concat(F.lit(', "seen": {"by": null, "ok": '), (event % 2 == 0).cast("string"), F.lit("}")))
        .otherwise(F.lit(', "tags": []'))
    )
    end = F.when(event % 11 == 0, "").otherwise("}")
    return table(spark, folder, "events").select("event_id", F.concat(F.lit('{"k": '), value, more, end).alias("text"))


@query
def document_fields(spark: SparkSession, folder: str) -> DataFrame:
    return variants.document_fields(variants.documents_of(_loose_documents(spark, folder), "text"), ["event_id"], "document")


@query
def document_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return variants.malformed(_loose_documents(spark, folder), "text")


@query
def document_field_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return variants.field_kinds(document_fields(spark, folder))


@query
def messages_any_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as documents under one of the four keys, some with the turn as text, some with a field more, and back to rows."""
    turns = table(spark, folder, "conversations")
    place = F.pmod("turn", F.lit(len(nested.MESSAGE_KEYS)))
    plain = F.to_json(F.array(F.struct("turn", "role", "text")))
    as_text = F.to_json(F.array(F.struct(F.concat(F.lit("no. "), F.col("turn").cast("string")).alias("turn"), "role", "text")))
    longer = F.to_json(F.array(F.struct("turn", "role", "text", F.length("text").alias("size"))))
    items = F.when(F.col("conv_id") % 3 == 0, plain).when(F.col("conv_id") % 3 == 1, as_text).otherwise(longer)
    key = F.element_at(F.array(*[F.lit(key) for key in nested.MESSAGE_KEYS]), (place + 1).cast("int"))
    text = F.concat(F.lit('{"messages": "none", "'), key, F.lit('": '), items, F.lit("}"))
    # the first key cannot stand twice: it holds the list or, where another does, a text
    text = F.when(place == 0, F.concat(F.lit('{"messages": '), items, F.lit("}"))).otherwise(text)
    documents_ = variants.documents_of(turns.select("conv_id", text.alias("text")), "text")
    found = variants.document_messages(documents_, ["conv_id"], "document", {"turn": "bigint", "role": "string", "text": "string", "size": "int"})
    return found.drop("message")


# loads ---------------------------------------------------------------------


@query
def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of each user between the first and the last day of all events."""
    days = table(spark, folder, "events").select("user_id", _day("ts").alias("day"))
    return missing_ranges(days, "day", by=["user_id"])


@query
def incremental_window(spark: SparkSession, folder: str) -> DataFrame:
    end = dates.yesterday(F.lit("1998-07-01 03:00:00").cast("timestamp"))
    orders = table(spark, folder, "orders")
    return read_increment(orders, "o_orderdate", date(1997, 1, 1), end).select("o_orderkey", "o_totalprice", _day("o_orderdate").alias("order_date"))


@query
def replace_range(spark: SparkSession, folder: str) -> DataFrame:
    start, end = date(1997, 1, 1), date(1997, 12, 31)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", _day("o_orderdate").alias("order_date"))
    corrected = read_increment(orders, "order_date", start, end).withColumn("o_totalprice", numbers.rounded(F.col("o_totalprice") * 1.1, 2))
    return replaced_range(orders, corrected, "order_date", start, end)


@query
def upsert_control(spark: SparkSession, folder: str) -> DataFrame:
    """A watermark per customer up to 1998, merged with the newer ones."""
    cut = F.lit("1998-01-01").cast("date")

    def watermark(orders: DataFrame, mode: str) -> DataFrame:
        newest = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(_max_day().alias("last_load"))
        return newest.withColumn("load_mode", F.lit(mode))

    def _max_day() -> Column:
        return F.max("o_orderdate").cast("date")

    orders = table(spark, folder, "orders")
    control = watermark(orders.where(F.col("o_orderdate") < cut), "F").withColumn("date_column", F.lit("o_orderdate"))
    return upserted(control, watermark(orders.where(F.col("o_orderdate") >= cut), "I"), ["customer_id"])
