"""Choosing, naming, typing and flattening columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from aljibe.functions.text import tidy_name


def select_or_null(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns in its order; absent ones are NULL."""
    return df.select(*[
        df[field.name] if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name)
        for field in schema
    ])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, ignore the others."""
    return df.withColumnsRenamed(dict(names))


def tidy_names(df: DataFrame) -> DataFrame:
    """Tidy every name, then merge columns whose names have become equal."""
    return merge_same_names(df.toDF(*[tidy_name(name) for name in df.columns]))


def merge_same_names(df: DataFrame) -> DataFrame:
    """One column per name, holding the first non-NULL value of its namesakes from left to right."""
    if len(set(df.columns)) == len(df.columns):
        return df
    places: dict[str, list[int]] = {}
    for place, name in enumerate(df.columns):
        places.setdefault(name, []).append(place)
    numbered = df.toDF(*[f"_{place}" for place in range(len(df.columns))])
    return numbered.select(*[
        F.coalesce(*[F.col(f"_{place}") for place in where]).alias(name) for name, where in places.items()
    ])


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct fields at any depth as top-level columns; arrays and maps stay as they are."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(F.col(".".join(f"`{part}`" for part in here)).alias(separator.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))


def with_lineage(
    df: DataFrame,
    dataset: str,
    source_file: str | Column,
    batch_id: str,
    ingested_at: datetime | str,
    run_date: str,
) -> DataFrame:
    """Origin columns. The ingestion time is an argument, so a re-run repeats the same rows.

    ``source_file`` may be ``F.col("_metadata.file_path")`` right after a file read.
    """
    origin = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns({
        "dataset_name": F.lit(dataset),
        "source_file": origin,
        "batch_id": F.lit(batch_id),
        "ingestion_ts": F.lit(str(ingested_at)),
        "run_date": F.lit(run_date),
    })


def typed(df: DataFrame, schema: StructType, coerce: bool = False) -> DataFrame:
    """Project to the schema with its types.

    A value that does not fit raises an error, or becomes NULL with ``coerce``.
    """
    present = select_or_null(df, schema)
    return present.select(*[
        (F.col(f.name).try_cast(f.dataType) if coerce else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in schema
    ])
