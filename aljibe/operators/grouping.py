"""Group totals, value counts, deduplication and top-n."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from aljibe.functions.numbers import MONEY, money_sum, percent


def total_by(df: DataFrame, by: Sequence[str], amount: str, name: str = "total") -> DataFrame:
    return df.groupBy(*by).agg(F.round(money_sum(F.col(amount)), 2).cast("double").alias(name))


def partial_totals(df: DataFrame, by: Sequence[str], amount: str, slice_of: Column) -> DataFrame:
    """Totals per slice, to be merged by ``merged_totals``. The slices may come from separate runs."""
    return df.groupBy(slice_of.alias("slice"), *by).agg(money_sum(F.col(amount)).cast(MONEY).alias("partial"))


def merged_totals(partials: DataFrame, by: Sequence[str], name: str = "total") -> DataFrame:
    return total_by(partials, by, "partial", name)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values including NULL; equal counts are ordered by value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, NULL keys being one key.

    Ties are broken by a hash of the whole row. Spark keeps one row per key and
    task before the shuffle (WindowGroupLimit), so a key with many rows sends few.
    """
    hashable = [field.name for field in df.schema if field.dataType.typeName() not in ("map", "variant")]
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*hashable))
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], moments: Sequence[str]) -> DataFrame:
    """The newest row per key by ``moments``, missing moments counting as oldest."""
    return first_per_key(df, keys, [F.desc_nulls_last(moment) for moment in moments])


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Distinct rows. Maps, which Spark cannot compare, are compared as sorted entries."""
    maps = [field for field in df.schema if field.dataType.typeName() == "map"]
    if not maps:
        return df.distinct()
    entries = df.withColumns({f.name: F.array_sort(F.map_entries(f.name)) for f in maps}).distinct()
    return entries.withColumns({f.name: F.map_from_entries(f.name) for f in maps})


def hashable(value: Column, kind: DataType) -> Column:
    """``value`` in a form whose hash tells all values apart.

    The hash of an array runs on from item to item and skips what is NULL, so it cannot tell ([1], [2]) from ([1, 2], []). Here each array comes after its
    size, each nested value after a mark that says whether it is NULL, and maps are arrays of entries by key.
    """
    def marked(inner: Column, inner_kind: DataType) -> Column:
        return F.struct(inner.isNull(), hashable(inner, inner_kind))

    if isinstance(kind, ArrayType):
        return F.struct(F.size(value), F.transform(value, lambda item: marked(item, kind.elementType)))
    if isinstance(kind, MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.struct(F.size(value), F.transform(keys, lambda key: F.struct(hashable(key, kind.keyType), marked(value[key], kind.valueType))))
    if isinstance(kind, StructType):
        return F.struct(*[marked(value.getField(field.name), field.dataType) for field in kind])
    return value


def row_copies(df: DataFrame) -> DataFrame:
    """``_n``: how often each distinct row occurs, and ``_nulls``: its NULL cells.

    Rows are told apart by two 64-bit hashes and a bit for each NULL cell, so a wide row is shuffled as a few bytes.
    Nested values are compared item by item, maps whatever the order of their entries.
    """
    cells = [(F.col(f"`{field.name}`"), field.dataType) for field in df.schema]
    values = [hashable(cell, kind) for cell, kind in cells]
    masks = []
    for first in range(0, len(cells), 63):
        bits = [F.when(cell.isNull(), F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint") for place, (cell, _) in enumerate(cells[first : first + 63])]
        masks.append(reduce(lambda one, other: one.bitwiseOR(other), bits).alias(f"_mask{len(masks)}"))
    names = ["_one", "_two", *[f"_mask{place}" for place in range(len(masks))]]
    key = [F.xxhash64(*values).alias("_one"), F.xxhash64(F.lit("row"), *values).alias("_two"), *masks]
    counted = df.select(*key).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    return counted.select("_n", reduce(lambda one, other: one + other, [F.bit_count(name) for name in names[2:]], F.lit(0)).alias("_nulls"))


def duplicate_share(df: DataFrame) -> DataFrame:
    """Row count, exact duplicates beyond the first, and their percentage."""
    copies = row_copies(df)
    total, extra = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return copies.agg(total.alias("n_rows"), extra.alias("duplicates"), percent(extra, total).alias("pct_duplicates"))


def product_by(df: DataFrame, by: Sequence[str], factor: Column, name: str = "product") -> DataFrame:
    return df.groupBy(*by).agg(F.product(factor).alias(name))


def table_stats(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    total = F.sum(value.cast(MONEY))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.round(total, 2).cast("double").alias("total"),
        F.round((total.cast("double") / F.count(value)).cast("decimal(38,6)"), 2).cast("double").alias("mean"),
    )


def item_counts(df: DataFrame, column: str, name: str = "item") -> DataFrame:
    """How often each item occurs in an array column."""
    return df.select(F.explode(column).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
