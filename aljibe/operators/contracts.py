"""Declared contracts: per-field checks, cross-field checks, schema drift."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType, StringType, StructType, TimestampNTZType,
)

from aljibe.errors import DataQualityError
from aljibe.functions.numbers import percent
from aljibe.operators.joins import with_group_size
from aljibe.operators.rules import Rule, holds, long_form
from aljibe.sinks.tables import publish


@dataclass(frozen=True)
class Field:
    """A column of a contract. ``checks`` are rules on the coerced value; they skip NULL."""

    name: str
    type: str
    nullable: bool = False
    unique: bool = False
    checks: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    cross_checks: tuple[Rule, ...] = field(default=())


def _raw(name: str) -> str:
    return f"_raw_{name}"


def _coerced(df: DataFrame, contract: Contract) -> DataFrame:
    """Fields in their declared types, beside the values as they came in."""
    kept = df.withColumns({_raw(f.name): F.col(f.name) for f in contract.fields})
    return kept.withColumns({f.name: F.col(f.name).try_cast(f.type) for f in contract.fields})


def _failures(coerced: DataFrame, contract: Contract, row_key: Sequence[str]) -> DataFrame:
    """The row key and an array of (column, check, value) for what the row breaks."""

    def failure(broken: Column, column: str, check: str, value: Column) -> Column:
        return F.when(broken, F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"), value.cast("string").alias("value")))

    found = []
    for f in contract.fields:
        raw, value = F.col(_raw(f.name)), F.col(f.name)
        found.append(failure(raw.isNotNull() & value.isNull(), f.name, f"type {f.type}", raw))
        if not f.nullable:
            found.append(failure(raw.isNull(), f.name, "not_null", raw))
        if _copies(f.name) in coerced.columns:
            found.append(failure(value.isNotNull() & (F.col(_copies(f.name)) > 1), f.name, "unique", value))
        found += [failure(~holds(rule), f.name, rule.name, value) for rule in f.checks]
    found += [failure(~holds(rule), "", rule.name, F.lit(None)) for rule in contract.cross_checks]
    # the key is shown as it came in
    names = {f.name for f in contract.fields}
    keys = [F.col(_raw(key) if key in names else key).alias(key) for key in row_key]
    return coerced.select(*keys, F.filter(F.array(*found), lambda one: one.isNotNull()).alias("_found"))


def _copies(name: str) -> str:
    return f"_copies_{name}"


def check_contract(df: DataFrame, contract: Contract, row_key: Sequence[str], keys_from: DataFrame | None = None) -> DataFrame:
    """One row per broken check: the row key, column, check and offending value.

    All checks share one pass over the rows; the values of a unique field are counted beside it, in ``keys_from``
    where it holds the same values but is cheaper to scan than ``df``.
    """
    sized, keys = _coerced(df, contract), df if keys_from is None else keys_from
    for f in contract.fields:
        if f.unique:
            sized = with_group_size(sized, [f.name], _copies(f.name), keys_from=keys.select(F.col(f.name).try_cast(f.type).alias(f.name)))
    return _failures(sized, contract, row_key).select(*row_key, F.inline("_found"))


def broken_rows(df: DataFrame, contract: Contract, row_key: Sequence[str]) -> DataFrame:
    """Rows breaking a field check, with the names of the broken fields. Nothing is shuffled."""
    failures = _failures(_coerced(df, contract), contract, row_key)
    names = F.array_distinct(F.transform("_found", lambda one: one["column"]))
    return failures.where(F.size("_found") > 0).select(*row_key, F.array_join(names, ",").alias("broken_fields"))


def require_contract(failures: DataFrame, table: str) -> None:
    """Store the failures of a contract in ``table`` and raise if there are any."""
    publish(failures, table)
    n = failures.sparkSession.table(table).count()
    if n:
        raise DataQualityError(f"{n} contract failures, see {table}")


def schema_drift(df: DataFrame, expected: StructType, by: str | None = None) -> DataFrame:
    """Expected and actual type per column, what became of it, and its fill rate.

    With ``by``, a partition column such as ``run_date``, fill rates are per value
    of it, which shows since when a new column has been filled.
    """
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    actual = {f.name: f.dataType.simpleString() for f in df.schema if f.name != by}
    names = [*wanted, *[name for name in actual if name not in wanted]]

    def state(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in wanted:
            return "added"
        return "same" if actual[name] == wanted[name] else "retyped"

    filled = [F.count(F.col(f"`{name}`")).alias(f"_{place}") for place, name in enumerate(names) if name in actual]
    counts = (df.groupBy(by) if by else df).agg(F.count(F.lit(1)).alias("_all"), *filled)
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(wanted.get(name)).cast("string").alias("expected_type"),
            F.lit(actual.get(name)).cast("string").alias("actual_type"),
            F.lit(state(name)).alias("state"),
            (percent(F.col(f"_{place}"), F.col("_all")) if name in actual else F.lit(0.0)).alias("pct_filled"),
        )
        for place, name in enumerate(names)
    ]
    if by is None:
        return long_form(counts, entries)
    return counts.select(F.col(by), F.inline(F.array(*entries)))


#: What a type may be widened to without losing a value, one step at a time; decimals by their digits.
WIDER = {
    "tinyint": ("smallint",), "smallint": ("int", "float"), "int": ("bigint", "double"), "bigint": (), "float": ("double",), "date": ("timestamp_ntz",),
    "char": ("string",), "varchar": ("string",),
}
#: Digits of the largest value of an integer type.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``, a different type."""
    one, other = old.simpleString(), new.simpleString()
    if isinstance(new, DecimalType):
        if isinstance(old, DecimalType):
            return one != other and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return new.precision - new.scale >= DIGITS.get(one, 99)
    return any(step == other or widens(_simple(step), new) for step in WIDER.get(one.partition("(")[0], ()))


def _simple(name: str) -> DataType:
    return {"smallint": ShortType(), "int": IntegerType(), "bigint": LongType(), "float": FloatType(), "double": DoubleType(), "string": StringType()}.get(name, TimestampNTZType())


def _children(kind: DataType) -> list[tuple[str, DataType]]:
    """What a type is made of: fields of a struct, items of an array, keys and values of a map."""
    if isinstance(kind, StructType):
        return [(f".{field.name}", field.dataType) for field in kind]
    if isinstance(kind, ArrayType):
        return [("[]", kind.elementType)]
    return [("{key}", kind.keyType), ("{value}", kind.valueType)] if isinstance(kind, MapType) else []


def type_drift(expected: StructType, actual: StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(path, expected type, actual type, state) of every column, field, item, key and value of either, outer ones first.

    Types that are made of others are compared by what they are made of, so such a path is ``same`` or ``retyped``, its parts tell the rest. Without its outer type a part is
    ``missing``, without an expected one ``added``; ``widened`` types hold every value of the expected one, ``narrowed`` ones are held by it.
    """
    def compare(path: str, old: DataType | None, new: DataType | None) -> list:
        inner_old, inner_new = dict(_children(old) if old else ()), dict(_children(new) if new else ())
        if old is None or new is None:
            state = "added" if old is None else "missing"
        elif inner_old or inner_new or isinstance(old, StructType) or isinstance(new, StructType):
            state = "same" if type(old) is type(new) else "retyped"
        else:
            state = "same" if old == new else "widened" if widens(old, new) else "narrowed" if widens(new, old) else "retyped"
        shown = [None if kind is None else kind.typeName() if _children(kind) else kind.simpleString() for kind in (old, new)]
        if state == "retyped":
            inner_old, inner_new = {}, {}
        below = [compare(path + step, inner_old.get(step), inner_new.get(step)) for step in [*inner_old, *[s for s in inner_new if s not in inner_old]]]
        return [(path, *shown, state), *[one for some in below for one in some]]

    columns = [dict((field.name, field.dataType) for field in schema) for schema in (expected, actual)]
    names = [*columns[0], *[name for name in columns[1] if name not in columns[0]]]
    return [one for name in names for one in compare(name, columns[0].get(name), columns[1].get(name))]


def _filled(value: Column, path: str) -> Column:
    """Whether anything but NULL stands at the rest of a path."""
    if not path:
        return value.isNotNull()
    step = re.match(r"\[\]|\{key\}|\{value\}|\.[^.\[{]+", path)[0]
    rest = path[len(step) :]
    if step.startswith("."):
        return _filled(value.getField(step[1:]), rest)
    items = {"[]": value, "{key}": F.map_keys(value), "{value}": F.map_values(value)}[step]
    return F.coalesce(F.exists(items, lambda item: _filled(item, rest)), F.lit(False))


def nested_drift(df: DataFrame, expected: StructType) -> DataFrame:
    """A row per path of the expected or the actual schema, nested ones too: path, expected_type, actual_type, state (``type_drift``) and
    pct_filled, the share of the rows that have anything there. One aggregate over ``df``, whatever the number of paths; names hold none of ``. [ {``."""
    found = type_drift(expected, df.schema)
    tops = {field.name for field in df.schema}

    def filled(path: str) -> Column:
        top = re.match(r"[^.\[{]+", path)[0]
        return F.count_if(_filled(F.col(f"`{top}`"), path[len(top) :]))

    counted = {place: filled(path) for place, (path, _, new, _) in enumerate(found) if new is not None and re.match(r"[^.\[{]+", path)[0] in tops}
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[count.alias(f"_{place}") for place, count in counted.items()])
    return long_form(counts, [
        F.struct(
            F.lit(path).alias("path"), F.lit(old).cast("string").alias("expected_type"), F.lit(new).cast("string").alias("actual_type"), F.lit(state).alias("state"),
            (percent(F.col(f"_{place}"), F.col("_all")) if place in counted else F.lit(0.0)).alias("pct_filled"),
        )
        for place, (path, old, new, state) in enumerate(found)
    ])


def read_all_versions(spark: SparkSession, path: str) -> DataFrame:
    """Every landed partition with the union of their columns; older rows have NULL in newer columns."""
    return spark.read.option("mergeSchema", True).parquet(path)
