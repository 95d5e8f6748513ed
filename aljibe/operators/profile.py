"""Dataset profiles: missing values, cardinality, quartiles, outliers, dictionary.

Reports are one row per column. Each reads a column in a fixed number of passes,
whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from aljibe.functions.numbers import nan_to_null, percent, rounded
from aljibe.operators.grouping import duplicate_share, row_copies
from aljibe.operators.rules import Rule, long_form, rule_report
from aljibe.session import staged

#: Types whose values are numbers of days or whole numbers of at most 64 bits.
INTEGERS = ("tinyint", "smallint", "int", "bigint", "date")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def _missing(name: str, kind: str) -> Column:
    value = F.col(f"`{name}`")
    return value.isNull() | F.isnan(value) if kind in ("double", "float") else value.isNull()


def missing_report(df: DataFrame) -> DataFrame:
    """Percentage of NULLs and NaNs per column."""
    nulls = [F.count_if(_missing(name, kind)).alias(name) for name, kind in df.dtypes]
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *nulls)
    return long_form(counts, [
        F.struct(F.lit(c).alias("column"), percent(F.col(c), F.col("_all")).alias("pct_missing")) for c in df.columns
    ])


def _each_column(df: DataFrame, columns: Sequence[str], counted: Callable[[int, str, Column], DataFrame]) -> DataFrame:
    """Union of ``counted(position, type, value)`` over ``columns``.

    Each branch scans its own column only, so together they read a table once and no row is multiplied by the columns.
    A frame that is dear to compute is best written to a table first.
    """
    kinds = dict(df.dtypes)
    branches = [counted(place, kinds[name], F.col(f"`{name}`")) for place, name in enumerate(columns)]
    return reduce(DataFrame.unionAll, branches)


def distinct_counts(df: DataFrame, name: str) -> DataFrame:
    """One row for a column: ``_all`` rows, ``_filled`` (neither NULL nor NaN) and ``_distinct`` values, exact.

    Integers and dates are kept as bitmaps of 64 neighbouring values, combined per task: a shuffled row stands for up to
    64 values, and where values lie far apart for one, as in a plain distinct. Other types go as counted values.
    """
    kind = dict(df.dtypes)[name]
    value = F.when(~_missing(name, kind), F.col(f"`{name}`"))
    if kind in INTEGERS:
        number = (F.unix_date(value) if kind == "date" else value).cast("bigint")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
        keyed, combined, values = F.shiftright(number, 6), F.bit_or("_bit").alias("_bits"), F.sum(F.bit_count("_bits"))
    else:
        bit, keyed, combined, values = F.lit(0), value, F.lit(0).alias("_bits"), F.count("_key")
    groups = df.select(keyed.alias("_key"), bit.alias("_bit")).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), combined)
    none = F.lit(0)
    return groups.agg(
        F.coalesce(F.sum("_n"), none).alias("_all"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n"))), none).alias("_filled"),
        F.coalesce(values, none).alias("_distinct"),
    )


def cardinality_report(df: DataFrame) -> DataFrame:
    """Type, NULLs (and NaNs), distinct values and their percentage of the rows, per column."""
    def of_column(place: int, kind: str, value: Column) -> DataFrame:
        name = df.columns[place]
        return distinct_counts(df, name).select(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            (F.col("_all") - F.col("_filled")).alias("nulls"),
            F.col("_distinct").alias("distinct_values"),
            percent(F.col("_distinct"), F.col("_all")).alias("pct_distinct"),
        )

    return _each_column(df, df.columns, of_column)


def _value_counts(df: DataFrame) -> DataFrame:
    """(column position, value as text, rows) over all columns, combined before the shuffle.

    Atomic values are counted as they are and written as text once per distinct value; nested ones are counted by their text.
    """
    def of_column(place: int, kind: str, value: Column) -> DataFrame:
        key = value.cast("string") if "<" in kind or kind == "variant" else value
        counted = df.select(key.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        return counted.select(F.lit(place).alias("position"), F.col("value").cast("string").alias("value"), "n")

    return _each_column(df, df.columns, of_column)


def data_dictionary(df: DataFrame, descriptions: Mapping[str, str] | None = None, examples: int = 3) -> DataFrame:
    """Description, type, NULLs, distinct values and the smallest example values (as text) per column."""
    described = descriptions or {}
    counts = _value_counts(df)
    totals = counts.groupBy("position").agg(
        F.sum("n").alias("_all"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    # per task only the smallest few values of a column go on (WindowGroupLimit); NULL comes last and is not collected
    smallest = (
        counts
        .withColumn("_place", F.row_number().over(Window.partitionBy("position").orderBy(F.asc_nulls_last("value"))))
        .where(F.col("_place") <= examples)
        .groupBy("position").agg(F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("examples"))
    )

    def of_column(texts: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(text) for text in texts]), F.col("position") + 1)

    names = df.columns
    return totals.join(smallest, "position", "left").select(
        of_column(names).alias("column"),
        of_column([described.get(name, "") for name in names]).alias("description"),
        of_column([kind for _, kind in df.dtypes]).alias("type"),
        "nulls",
        percent(F.col("nulls"), F.col("_all")).alias("pct_nulls"),
        "distinct_values",
        F.coalesce("examples", F.lit("")).alias("examples"),
    )


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column position, value, rows) over numeric columns, without NULL and NaN, combined per task before the shuffle.

    Written to the shared folder: every figure of a profile is read from it.
    """
    def of_column(place: int, kind: str, value: Column) -> DataFrame:
        filled = df.select(nan_to_null(value.cast("double")).alias("value")).where("value is not null")
        return filled.groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("position"), "value", "n")

    if not columns:
        return df.sparkSession.createDataFrame([], "position int, value double, n bigint")
    return staged(_each_column(df, columns, of_column))


def quantiles_of_counts(counts: DataFrame, fractions: Sequence[float]) -> dict[int, list[float]]:
    """Linearly interpolated quantiles per position, exact for any number of values. Runs jobs.

    The counted values are dealt by range. The rows per range, added up, tell in which range an order statistic
    lies, and only there values are numbered. No task holds more than a range; the driver gets a few numbers per column.
    """
    dealt = staged(counts.repartitionByRange("position", "value").withColumn("range", F.spark_partition_id()))
    in_order = Window.partitionBy("position").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("position", "range").agg(F.sum("n").alias("rows"))
    ranges = sizes.withColumn("below", F.coalesce(F.sum("rows").over(in_order), F.lit(0)))
    totals = sizes.groupBy("position").agg(F.sum("rows").alias("total"))
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.lit(float(f)).alias("fraction")) for i, f in enumerate(fractions)]))
    wanted = totals.select("position", "total", places.alias("at")).select(
        "position", "at.which", (F.col("at.fraction") * (F.col("total") - 1)).alias("place"), "total")
    low = F.floor("place").cast("bigint")
    ranks = wanted.select("position", "which", (F.col("place") - low).alias("part"), F.posexplode(F.array(low, F.least(low + 1, F.col("total") - 1))).alias("side", "rank"))
    held = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("rows"))
    found = ranks.join(ranges, "position").where(held).select("position", "range", "below", "which", "part", "side", "rank")
    within = Window.partitionBy("position", "range").orderBy("value")
    needed = dealt.join(found.select("position", "range").distinct(), ["position", "range"], "left_semi")
    numbered = needed.withColumn("upto", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    hits = numbered.join(found, ["position", "range"]).where((F.col("rank") - F.col("below") < F.col("upto")) & (F.col("rank") - F.col("below") >= F.col("upto") - F.col("n")))
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("value")))
    read = hits.groupBy("position", "which").agg(side(0).alias("under"), side(1).alias("over"), F.max("part").alias("part")).collect()
    out: dict[int, list[float]] = {r["position"]: [0.0] * len(fractions) for r in read}
    for r in read:
        out[r["position"]][r["which"]] = r["under"] + (r["over"] - r["under"]) * r["part"]
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, exact for data of any size; NULL and NaN do not count. Runs jobs."""
    found = quantiles_of_counts(_numbers(df, columns), fractions)
    return {name: found.get(place, [None] * len(fractions)) for place, name in enumerate(columns)}


def _of_place(columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("position") + 1)


def outlier_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR limits and values outside them, per numeric column with any values; NaN is missing. Runs jobs."""
    columns = [*(columns if columns is not None else numeric_columns(df))]
    counts = _numbers(df, columns)
    limits = {place: (q1, q3, q3 - q1, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for place, (q1, q3) in quantiles_of_counts(counts, [0.25, 0.75]).items()}
    schema = "column string, q1 double, q3 double, iqr double, lower_limit double, upper_limit double, outliers bigint, pct_outliers double"
    if not limits:
        return df.sparkSession.createDataFrame([], schema)
    names = ("q1", "q3", "iqr", "lower_limit", "upper_limit")
    known = F.create_map(*[x for place, numbers in limits.items() for x in (F.lit(place), F.struct(*[F.lit(v).alias(n) for n, v in zip(names, numbers)]))])
    limit = known[F.col("position")]
    outside = (F.col("value") < limit["lower_limit"]) | (F.col("value") > limit["upper_limit"])
    sums = counts.groupBy("position").agg(F.sum("n").alias("_n"), F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outliers"))
    return sums.select(
        _of_place(columns).alias("column"), *[rounded(limit[name], 3).alias(name) for name in names], "outliers", percent(F.col("outliers"), F.col("_n")).alias("pct_outliers"))


def describe_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column; NaN is missing. Runs jobs."""
    columns = [*(columns if columns is not None else numeric_columns(df))]
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    sums = []
    for place, name in enumerate(columns):
        value = nan_to_null(F.col(f"`{name}`").cast("double"))
        sums += [
            F.count(value).alias(f"_n{place}"), F.avg(value).alias(f"_mean{place}"), F.stddev_samp(value).alias(f"_std{place}"),
            F.min(value).alias(f"_min{place}"), F.max(value).alias(f"_max{place}"),
        ]
    return long_form(df.agg(*sums), [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_n{place}").alias("n"),
            rounded(F.col(f"_mean{place}"), 4).alias("mean"),
            rounded(F.col(f"_std{place}"), 4).alias("std"),
            F.col(f"_min{place}").alias("min"),
            *[F.lit(number).cast("double").alias(label) for label, number in zip(("q1", "median", "q3"), quartiles[name])],
            F.col(f"_max{place}").alias("max"),
        )
        for place, name in enumerate(columns)
    ])


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value (smallest of equals) and its frequency per text column."""
    columns = [*(columns if columns is not None else [name for name, kind in df.dtypes if kind == "string"])]
    top = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("less"), F.col("value").alias("value"))))
    return _value_counts(df.select(*columns)).groupBy("position").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n"),
        F.count("value").alias("distinct_values"),
        top.alias("_top"),
    ).select(
        F.element_at(F.array(*[F.lit(name) for name in columns]), F.col("position") + 1).alias("column"),
        "n", "distinct_values", F.col("_top.value").alias("top"), (-F.col("_top.less")).alias("freq"),
    )


def size_and_gaps(df: DataFrame, dataset: str) -> DataFrame:
    """One row: rows, columns, exact duplicates and NULL cells of a dataset."""
    none = F.lit(0).cast("bigint")
    return row_copies(df).agg(
        F.coalesce(F.sum("_n"), none).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), none).alias("duplicates"),
        F.coalesce(F.sum(F.col("_n") * F.col("_nulls")), none).alias("null_cells"),
    ).select(F.lit(dataset).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "duplicates", "null_cells")


def before_and_after(raw: DataFrame, clean: DataFrame) -> DataFrame:
    return size_and_gaps(raw, "raw").unionByName(size_and_gaps(clean, "clean"))


def dataset_summary(df: DataFrame, rules: Sequence[Rule], top: int = 5) -> DataFrame:
    """Rows, columns, duplicates, the columns with most NULLs and the rules broken most, as (section, name, value)."""
    duplicates = duplicate_share(df)
    size = long_form(duplicates, [
        F.struct(F.lit("size").alias("section"), F.lit(name).alias("name"), value.cast("double").alias("value"))
        for name, value in (("rows", F.col("n_rows")), ("columns", F.lit(len(df.columns))), ("exact_duplicates", F.col("duplicates")))
    ])
    nulls = (
        missing_report(df).orderBy(F.desc("pct_missing"), "column").limit(top)
        .select(F.lit("missing").alias("section"), F.col("column").alias("name"), F.col("pct_missing").alias("value"))
    )
    broken = (
        rule_report(df, rules).orderBy(F.desc("pct_invalid"), "rule").limit(top)
        .select(F.lit("rules").alias("section"), F.col("rule").alias("name"), F.col("pct_invalid").alias("value"))
    )
    return size.unionByName(nulls).unionByName(broken)
