"""Expectation suites with tolerance, the quality gate and its audit.

All expectations of a suite are conditional counts in one aggregate over one
scan. Uniqueness alone needs a shuffle, of the key column, counted per key
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.errors import QualityGateError
from aljibe.functions.numbers import percent
from aljibe.operators.rules import long_form

# columns of a result, also the schema to read saved results with
RESULT = (
    "suite string, position int, expectation string, column string, element_count bigint, null_count bigint, "
    "unexpected bigint, unexpected_pct double, success boolean"
)


@dataclass(frozen=True)
class Expectation:
    """One check. ``kind`` is columns, not_null, unique, in_set, regex or between.

    ``mostly`` is the share of non-NULL values that has to comply.
    """

    kind: str
    column: str = ""
    values: tuple = ()
    mostly: float = 1.0

    def met(self) -> Column:
        value = F.col(self.column)
        if self.kind == "in_set":
            return value.isin(*self.values)
        if self.kind == "regex":
            return value.rlike(self.values[0])
        if self.kind == "between":
            return value.between(F.lit(self.values[0]), F.lit(self.values[1]))
        raise ValueError(f"unknown expectation {self.kind!r}")


def columns_are(*names: str) -> Expectation:
    return Expectation("columns", values=names)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly=mostly)


def unique(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("unique", column, mostly=mostly)


def in_set(column: str, *values: object, mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, values, mostly)


def matches(column: str, pattern: str, mostly: float = 1.0) -> Expectation:
    return Expectation("regex", column, (pattern,), mostly)


def between(column: str, low: object, high: object, mostly: float = 1.0) -> Expectation:
    return Expectation("between", column, (low, high), mostly)


def _entry(place: int, expectation: Expectation, rows: Column, nulls: Column, unexpected: Column) -> Column:
    # a missing value is the finding of not_null, for all other kinds it leaves the base
    base = rows if expectation.kind == "not_null" else rows - nulls
    # the ratio, not a product: 55 of 100 is 0.55 in binary too, while 0.55 * 100 is a little more than 55
    enough = (base == 0) | ((base - unexpected).cast("double") / F.nullif(base, F.lit(0)) >= expectation.mostly)
    return F.struct(
        F.lit(place).alias("position"),
        F.lit(expectation.kind).alias("expectation"),
        F.lit(expectation.column).alias("column"),
        rows.alias("element_count"),
        nulls.alias("null_count"),
        unexpected.alias("unexpected"),
        percent(unexpected, base).alias("unexpected_pct"),
        enough.alias("success"),
    )


def run_suite(df: DataFrame, expectations: Sequence[Expectation], suite: str, keys_from: DataFrame | None = None) -> DataFrame:
    """One result row per expectation, with its position in the suite.

    ``keys_from`` may name a frame with the same values of the unique columns that is
    cheaper to scan than ``df``, such as the table it was derived from.
    """
    numbered = list(enumerate(expectations))
    # the row count, and per column and per expectation one conditional count
    sums = {"rows": F.count(F.lit(1))}
    for place, one in numbered:
        if one.kind in ("columns", "unique"):
            continue
        sums[f"nulls_{one.column}"] = F.count_if(F.col(one.column).isNull())
        if one.kind != "not_null":
            sums[f"unexpected_{place}"] = F.count_if(~one.met())
    counted = df.agg(*[value.alias(name) for name, value in sums.items()])

    entries = []
    for place, one in numbered:
        if one.kind == "columns":
            wrong = F.lit(0 if tuple(df.columns) == one.values else 1).cast("bigint")
            entries.append(F.struct(
                F.lit(place).alias("position"), F.lit(one.kind).alias("expectation"), F.lit("").alias("column"),
                F.col("rows").alias("element_count"), F.lit(0).cast("bigint").alias("null_count"),
                wrong.alias("unexpected"), F.lit(0.0).alias("unexpected_pct"), (wrong == 0).alias("success"),
            ))
        elif one.kind == "not_null":
            missing = F.col(f"nulls_{one.column}")
            entries.append(_entry(place, one, F.col("rows"), missing, missing))
        elif one.kind != "unique":
            entries.append(_entry(place, one, F.col("rows"), F.col(f"nulls_{one.column}"), F.col(f"unexpected_{place}")))
    parts = [long_form(counted, entries)] if entries else []

    for place, one in numbered:
        if one.kind == "unique":
            per_key = (df if keys_from is None else keys_from).groupBy(F.col(one.column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            known = F.col("key").isNotNull()
            none = F.lit(0).cast("bigint")
            totals = per_key.agg(
                F.coalesce(F.sum("n"), none).alias("rows"),
                F.coalesce(F.sum(F.when(~known, F.col("n"))), none).alias("nulls"),
                # every member of a group of duplicates is unexpected
                F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), none).alias("unexpected"),
            )
            parts.append(long_form(totals, [_entry(place, one, F.col("rows"), F.col("nulls"), F.col("unexpected"))]))
    results = reduce(DataFrame.unionByName, parts)
    return results.select(F.lit(suite).alias("suite"), *results.columns)


def gate(results: DataFrame) -> DataFrame:
    """Outcome per suite, and of all suites together in the row ``overall``."""
    return (
        results.rollup("suite").agg(F.bool_and("success").alias("success"))
        .select(F.coalesce("suite", F.lit("overall")).alias("suite"), "success")
    )


def require_gate(results: DataFrame) -> None:
    """Raise QualityGateError naming the failed suites. Runs one aggregate; a result has one row per suite."""
    failed = sorted(row["suite"] for row in results.groupBy("suite").agg(F.bool_and("success").alias("ok")).where("not ok").collect())
    if failed:
        raise QualityGateError(f"failed suites: {', '.join(failed)}")


def audit(results: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful expectations per suite."""
    return results.groupBy("suite").agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
    )
