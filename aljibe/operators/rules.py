"""Named row rules: flags, failed rules, quarantine, reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.functions.nested import failing
from aljibe.functions.numbers import percent


class Rule(NamedTuple):
    """A condition valid rows meet. ``on_null`` says whether an undecided condition counts as "pass" or "fail"."""

    name: str
    check: Column
    on_null: str = "pass"


def holds(rule: Rule) -> Column:
    """The rule's outcome, never NULL."""
    if rule.on_null not in ("pass", "fail"):
        raise ValueError(f"rule {rule.name}: on_null is {rule.on_null!r}")
    return F.coalesce(rule.check, F.lit(rule.on_null == "pass"))


def with_flags(df: DataFrame, rules: Sequence[Rule], prefix: str = "rule_") -> DataFrame:
    """One boolean column per rule, NULL where the condition is undecided."""
    return df.withColumns({f"{prefix}{rule.name}": rule.check for rule in rules})


def with_failed_rules(df: DataFrame, rules: Sequence[Rule], prefix: str = "rule_") -> DataFrame:
    """``failed_rules`` (names in rule order) and ``is_valid``, from the flag columns."""
    flagged = [rule._replace(check=F.col(f"{prefix}{rule.name}")) for rule in rules]
    failed = failing([(f"{prefix}{rule.name}", ~holds(rule)) for rule in flagged])
    return df.withColumn("failed_rules", failed).withColumn("is_valid", F.size("failed_rules") == 0)


def accepted(flagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Valid rows with the original columns only."""
    return flagged.where("is_valid").select(*columns)


def quarantined(flagged: DataFrame) -> DataFrame:
    """Invalid rows with their flags and failed rules."""
    return flagged.where(~F.col("is_valid"))


def reconciled(flagged: DataFrame) -> DataFrame:
    """Counts of all, valid and invalid rows, and whether they add up."""
    raw, silver, quarantine = F.count(F.lit(1)), F.count_if(F.col("is_valid")), F.count_if(~F.col("is_valid"))
    return flagged.agg(
        raw.alias("raw_count"), silver.alias("silver_count"), quarantine.alias("quarantine_count"),
        (raw == silver + quarantine).alias("balanced"),
    )


def reconciled_tables(raw: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """The same check between three written tables."""
    def counted(df: DataFrame, place: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).withColumn("place", F.lit(place))

    counts = counted(raw, "raw").union(counted(silver, "silver")).union(counted(quarantine, "quarantine"))
    of = {place: F.sum(F.when(F.col("place") == place, F.col("n"))) for place in ("raw", "silver", "quarantine")}
    return counts.agg(
        of["raw"].alias("raw_count"), of["silver"].alias("silver_count"), of["quarantine"].alias("quarantine_count"),
        (of["raw"] == of["silver"] + of["quarantine"]).alias("balanced"),
    )


def long_form(one_row: DataFrame, entries: Iterable[Column]) -> DataFrame:
    """One row per struct of ``entries``, computed from a one-row aggregate."""
    return one_row.select(F.inline(F.array(*entries)))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Invalid rows and their percentage per rule, from a single pass."""
    broken = [F.count_if(~holds(rule)).alias(f"_{place}") for place, rule in enumerate(rules)]
    sums = df.agg(F.count(F.lit(1)).alias("_all"), *broken)
    return long_form(sums, [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"_{place}").alias("invalid_rows"),
            percent(F.col(f"_{place}"), F.col("_all")).alias("pct_invalid"),
        )
        for place, rule in enumerate(rules)
    ])
