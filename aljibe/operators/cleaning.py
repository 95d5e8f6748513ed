"""The cleaning pass: tidy text, invalid values to NULL, exact duplicates removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aljibe.functions.text import normalized, recoded


def clean(
    df: DataFrame,
    text: Sequence[str],
    valid: Mapping[str, Column],
    recode: Mapping[str, Mapping[str, str]] | None = None,
    recompute: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Normalise ``text`` columns and recode their categories, set values failing ``valid`` to NULL,
    drop exact duplicates, then recompute derived columns in the given order."""
    out = df.withColumns({c: recoded(normalized(F.col(c)), (recode or {}).get(c, {})) for c in text})
    out = out.withColumns({c: F.when(condition, F.col(c)) for c, condition in valid.items()}).distinct()
    for name, value in (recompute or {}).items():
        out = out.withColumn(name, value)
    return out
