"""JSON documents without a declared schema, as VARIANT: fields that nobody expected, and values of other types, are kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.functions.nested import MESSAGE_KEYS


def documents_of(df: DataFrame, text: str, name: str = "document") -> DataFrame:
    """The rows whose ``text`` is JSON, with the document as a VARIANT column. As Spark's parser does, text after the document is ignored."""
    return df.withColumn(name, F.try_parse_json(text)).where(F.col(name).isNotNull())


def malformed(df: DataFrame, text: str) -> DataFrame:
    """The rows whose ``text`` is not NULL and no JSON: with ``documents_of`` and the NULLs they are all rows."""
    return df.where(F.col(text).isNotNull() & F.try_parse_json(text).isNull())


def kind_of(value: Column) -> Column:
    """OBJECT, ARRAY, or the type of a plain value; VOID for JSON null."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z_]+", 0)


def document_fields(df: DataFrame, keep: Sequence[str], document: str, depth: int = 6) -> DataFrame:
    """One row per plain value of a document: ``path`` (``$.a.b[0]``), ``kind`` and ``value`` as JSON text.

    Objects and arrays are opened ``depth`` times; what lies deeper, and empty ones, are rows of their own with their JSON text. One scan, whatever the depth:
    each level opens what it can and passes the rest on. Nothing is shuffled.
    """
    rows = df.select(*keep, F.lit("$").alias("path"), F.col(document).alias("_value"))
    for _ in range(depth):
        opened = rows.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("_value").outer()))
        step = F.coalesce(F.concat(F.lit("."), "key"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")), F.lit(""))
        value = F.when(F.col("pos").isNull(), F.col("_value")).otherwise(F.col("value"))
        rows = opened.select(*keep, F.concat("path", step).alias("path"), value.alias("_value"))
    return rows.select(*keep, "path", kind_of(F.col("_value")).alias("kind"), F.to_json("_value").alias("value"))


def field_kinds(fields: DataFrame) -> DataFrame:
    """Per path, list places apart, and kind: how many values there are. A path with two kinds, or a rare one, is drift."""
    shape = F.regexp_replace("path", r"\[\d+\]", "[]")
    return fields.groupBy(shape.alias("path"), "kind").agg(F.count(F.lit(1)).alias("n"))


def list_in(document: Column, keys: Sequence[str] = MESSAGE_KEYS) -> Column:
    """The list under the first of ``keys`` that holds one, as VARIANT; NULL without."""
    under = [F.try_variant_get(document, f"$.{key}", "variant") for key in keys]
    return F.coalesce(*[F.when(kind_of(one) == "ARRAY", one) for one in under])


def document_messages(df: DataFrame, keep: Sequence[str], document: str, fields: Mapping[str, str], keys: Sequence[str] = MESSAGE_KEYS) -> DataFrame:
    """One row per item of a document's message list: its ``place``, the ``fields`` in their types, its ``shape`` and the whole ``message`` as JSON text.

    A field that is missing or of a type that cannot be cast is NULL; ``shape`` and ``message`` still have it.
    """
    lists = df.select(*keep, list_in(F.col(document), keys).alias("_list"))
    items = lists.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_list").outer()))
    typed = [F.try_variant_get("value", f"$.{name}", kind).alias(name) for name, kind in fields.items()]
    return items.select(*keep, F.col("pos").alias("place"), *typed, F.schema_of_variant("value").alias("shape"), F.to_json("value").alias("message"))
