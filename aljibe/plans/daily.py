"""Daily load: bronze, silver with rejects, gold, anomaly alert, version audit."""

from __future__ import annotations

import logging
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from aljibe.errors import DataQualityError, EmptyDatasetError
from aljibe.operators import anomalies, models, rejects
from aljibe.operators.columns import typed
from aljibe.operators.grouping import latest_per_key
from aljibe.operators.opslog import ALERTS, EVENTS, VERSIONS, log_rows
from aljibe.session import stage, unstage
from aljibe.sinks.changes import BUCKET, bucket_layout, create_bucketed, replace_buckets, replace_days, touched_buckets
from aljibe.sinks.tables import append, create_schemas, create_table, partitions, publish
from aljibe.sources.files import require_rows

log = logging.getLogger(__name__)

# Columns of the bronze, silver and gold tables.
_LOADED = [
    StructField("_ingestion_ts", TimestampType()), StructField("_source_file", StringType()),
    StructField("_run_id", StringType()), StructField("_run_date", DateType()),
]
ORDERS = StructType([
    StructField("order_id", LongType()), StructField("customer_id", IntegerType()), StructField("order_date", DateType()),
    StructField("amount", DoubleType()), StructField("status", StringType()), *_LOADED,
])
REJECTS = StructType([*ORDERS.fields, StructField("reject_reason", StringType())])
CUSTOMERS = StructType([
    StructField("customer_id", IntegerType()), StructField("customer_name", StringType()), StructField("country", StringType()),
    StructField("email", StringType()), StructField("updated_at", TimestampType()), *_LOADED,
])
DAILY = StructType([
    StructField("order_date", DateType()), StructField("total_orders", LongType()),
    StructField("total_revenue", DoubleType()), StructField("avg_ticket", DoubleType()),
])
BY_COUNTRY = StructType([
    StructField("order_date", DateType()), StructField("country", StringType()),
    StructField("total_orders", LongType()), StructField("total_revenue", DoubleType()),
])


class DailyLoad:
    """One run of the daily load into the schemas ``{prefix}_bronze``, ``_silver``, ``_gold`` and ``_ops``.

    Bronze, silver orders and gold are partitioned by day, silver customers by a hash of their id; a run reads and rewrites the days and the
    ``customer_buckets`` it touches. Two things cost more: customers that are new or in another country cost a scan of the customer and the date of all silver
    orders, and a date that is loaded again costs a scan of bronze and silver customers. Log rows are collected and appended once per stage.
    """

    def __init__(self, spark: SparkSession, run_date: date, run_id: str, prefix: str, now: datetime | None = None, customer_buckets: int = 16):
        self.spark, self.run_date, self.run_id, self.prefix, self.customer_buckets = spark, run_date, run_id, prefix, customer_buckets
        self.loaded_before = True  # unless ``bronze`` has seen that no customers of the date have landed
        self.now = now or datetime.now(timezone.utc).replace(tzinfo=None)
        self.events: list[dict] = []
        self.versions: list[dict] = []

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def setup(self) -> None:
        create_schemas(self.spark, *[f"{self.prefix}_{layer}" for layer in ("bronze", "silver", "gold", "ops")])
        create_table(self.spark, self.name("bronze", "orders"), ORDERS, ("_run_date",))
        create_table(self.spark, self.name("bronze", "customers"), CUSTOMERS, ("_run_date",))
        create_table(self.spark, self.name("silver", "orders"), ORDERS, ("_run_date",))
        create_table(self.spark, self.name("silver", "orders_reject"), REJECTS, ("_run_date",))
        create_bucketed(self.spark, self.name("silver", "customers"), CUSTOMERS, ["customer_id"], self.customer_buckets)
        create_table(self.spark, self.name("gold", "daily_sales"), DAILY, ("order_date",))
        create_table(self.spark, self.name("gold", "sales_by_country"), BY_COUNTRY, ("order_date",))
        for table, schema in (("pipeline_events", EVENTS), ("pipeline_alerts", ALERTS), ("dataset_versions", VERSIONS)):
            create_table(self.spark, self.name("ops", table), schema)

    def event(self, level: str, stage: str, dataset: str, status: str, message: str, **more: object) -> None:
        self.events.append(dict(
            event_ts=self.now, level=level, run_id=self.run_id, stage=stage, dataset=dataset, status=status, message=message, **more))

    def published(self, table: str, operation: str, rows: int) -> None:
        """Record a publish: table and rows written. Its version, one above the last, is given when the log is written."""
        self.versions.append(dict(
            audit_ts=self.now, run_id=self.run_id, table_name=table, operation=operation, operation_ts=self.now, num_output_rows=str(rows)))

    def write_log(self) -> None:
        """Append what has been collected, one write per log table."""
        if self.versions:
            table = self.name("ops", "dataset_versions")
            last = {r[0]: r[1] for r in self.spark.table(table).groupBy("table_name").agg(F.max("version")).collect()}
            for row in self.versions:
                row["version"] = last[row["table_name"]] = last.get(row["table_name"], -1) + 1
            append(log_rows(self.spark, VERSIONS, self.versions), table)
        if self.events:
            append(log_rows(self.spark, EVENTS, self.events), self.name("ops", "pipeline_events"))
        self.versions, self.events = [], []

    def _replace_days(self, rows: DataFrame, table: str, column: str, days: set[date]) -> None:
        self.published(table, "REPLACE DAY", replace_days(self.spark, rows, table, column, days))

    def bronze(self, dataset: str, landed: DataFrame, source_file: str) -> None:
        """Add the day's landing rows. Loading a day again replaces that day."""
        schema = ORDERS if dataset == "orders" else CUSTOMERS
        rows = landed.withColumns({
            "_ingestion_ts": F.lit(self.now), "_source_file": F.lit(source_file),
            "_run_id": F.lit(self.run_id), "_run_date": F.lit(self.run_date),
        })
        if dataset == "customers":
            self.loaded_before = f"_run_date={self.run_date}" in partitions(self.spark, self.name("bronze", "customers"))
        self._replace_days(typed(rows, schema, coerce=True), self.name("bronze", dataset), "_run_date", {self.run_date})

    def _of_run(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table)).where(F.col("_run_date") == F.lit(self.run_date))

    def _order_dates(self) -> set[date]:
        """Order dates among the run date's silver orders: calendar days, never data rows."""
        return {r[0] for r in self._of_run("silver", "orders").select("order_date").distinct().collect()}

    def silver(self, rebuild: bool = False) -> set[date]:
        """Check the day's reject rate, split its orders, merge its customers; the order dates whose sales have changed.

        An order's verdict depends on its own row only, so just the day's
        partition is written; ``rebuild`` splits all days again.
        """
        orders = self.spark.table(self.name("bronze", "orders"))
        day = require_rows(self._of_run("bronze", "orders"), f"orders of {self.run_date}")
        total, rejected = rejects.require_reject_rate(day)
        touched = self._order_dates()
        for rows, schema, table in ((rejects.valid_orders, ORDERS, "orders"), (rejects.rejected_orders, REJECTS, "orders_reject")):
            if rebuild:
                written = publish(typed(rows(orders), schema), self.name("silver", table), partitioned_by=("_run_date",))
                self.published(self.name("silver", table), "OVERWRITE", written)
            else:
                self._replace_days(typed(rows(day), schema), self.name("silver", table), "_run_date", {self.run_date})
        moved = self._merge_customers()
        self.event("INFO", "silver", "orders", "OK", "silver done", rows_ok=total - rejected, rows_reject=rejected,
                   extra={"current_run_rows": total, "current_run_rejects": rejected})
        return touched | self._order_dates() | moved

    def _merge_customers(self) -> set[date]:
        """Merge the customers landed on the run date into their buckets; the order dates of those that are new, gone or in another country.

        A customer that silver has from an earlier load of the same date is taken from all bronze days again: the new landing may lack it.
        """
        silver, newest_first = self.name("silver", "customers"), ["updated_at", "_ingestion_ts"]
        landed, bronze, old = self._of_run("bronze", "customers"), self.spark.table(self.name("bronze", "customers")), self.spark.table(silver)
        ids = landed.select(F.col("customer_id").alias("_id"))
        if self.loaded_before:
            ids = ids.unionByName(self._of_run("silver", "customers").select(F.col("customer_id").alias("_id")))
        path = stage(ids.distinct())
        try:
            ids = self.spark.read.schema(ids.schema).parquet(path)
            met = F.col("customer_id").eqNullSafe(F.col("_id"))
            buckets = touched_buckets(ids.withColumnRenamed("_id", "customer_id"), *bucket_layout(self.spark, silver))
            if not buckets:
                return set()
            old = old.where(F.col(BUCKET).isin(*buckets)).drop(BUCKET)
            earlier = old.where(F.col("_run_date") != F.lit(self.run_date))
            versions = earlier.unionByName(bronze if self.loaded_before else landed).join(ids, met, "left_semi")
            merged = typed(latest_per_key(versions, ["customer_id"], newest_first), CUSTOMERS)
            before = old.join(ids, met, "left_semi").select("customer_id", F.col("country").alias("_before"))
            both = merged.select("customer_id", "country").join(before, "customer_id", "full_outer")
            changed = both.where(~F.col("country").eqNullSafe(F.col("_before"))).select("customer_id")
            days = set()
            if not changed.isEmpty():
                orders = self.spark.table(self.name("silver", "orders")).join(changed, "customer_id", "left_semi")
                days = {r[0] for r in orders.select("order_date").where("order_date is not null").distinct().collect()}
            rows = replace_buckets(self.spark, typed(earlier.join(ids, met, "left_anti").unionByName(merged), CUSTOMERS), silver, buckets)
            self.published(silver, "MERGE", rows)
            return days
        finally:
            unstage(self.spark, path)

    def gold(self, days: set[date] | None = None) -> bool:
        """Compute the sales of ``days`` (all, if None) anew in both gold tables; True if the run date's revenue has dropped, with an alert row."""
        orders = self.spark.table(self.name("silver", "orders"))
        customers = require_rows(self.spark.table(self.name("silver", "customers")).drop(BUCKET), "silver customers")
        days = {r[0] for r in orders.select("order_date").distinct().collect()} if days is None else days
        orders = require_rows(orders.where(F.col("order_date").isin(*days) if days else F.lit(False)), "silver orders")
        for rows, schema, table in ((models.daily_sales(orders), DAILY, "daily_sales"), (models.sales_by_country(orders, customers), BY_COUNTRY, "sales_by_country")):
            self._replace_days(typed(rows, schema), self.name("gold", table), "order_date", days)
        daily = self.spark.table(self.name("gold", "daily_sales"))
        if daily.where(F.col("order_date") == F.lit(self.run_date)).isEmpty():
            raise EmptyDatasetError(f"no gold row for {self.run_date}")
        drops = anomalies.revenue_drop_on(daily, self.run_date)
        dropped = not drops.isEmpty()
        if dropped:
            append(typed(anomalies.drop_alerts(drops, self.run_id, self.now), ALERTS), self.name("ops", "pipeline_alerts"))
            self.event("WARN", "gold", "daily_sales", "ALERT", "revenue below the preceding days")
        self.event("INFO", "gold", "gold_tables", "OK", "gold published", rows_ok=len(days))
        return dropped

    def run(self, orders: DataFrame, customers: DataFrame, source_files: tuple[str, str] = ("orders.csv", "customers.jsonl")) -> bool:
        """All stages. A failing stage leaves an ERROR event and an alert and raises."""
        self.setup()
        outcome = None
        stages = (
            ("bronze", lambda _: [self.bronze("orders", orders, source_files[0]), self.bronze("customers", customers, source_files[1])]),
            ("silver", lambda _: self.silver()),
            ("gold", self.gold),
        )
        for stage, step in stages:
            self.event("INFO", stage, "all", "STARTED", f"{stage} started")
            try:
                outcome = step(outcome)
                self.write_log()
            except Exception as error:
                code = "DQ_001" if isinstance(error, DataQualityError) else "SYS_001"
                self.event("ERROR", stage, "all", "FAILED", str(error), error_code=code)
                failed = log_rows(self.spark, EVENTS, [self.events[-1]])
                self.write_log()
                append(typed(anomalies.failure_alerts(failed), ALERTS), self.name("ops", "pipeline_alerts"))
                log.error("stage %s failed: %s", stage, error)
                raise
        return bool(outcome)
