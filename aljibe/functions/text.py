"""Text clean-up, recoding and pattern checks."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The two e-mail patterns, strict and simple.
EMAIL_STRICT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
EMAIL_SIMPLE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñç"
PLAIN = "aaaaaaeeeeiiiiooooouuuunc"


def tidy_name(name: str) -> str:
    """Column name in lower case with space, dot and dash as underscore."""
    return re.sub(r"[ .\-]", "_", name.strip().lower())


def stripped(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(value, F.lit(" \t\n\x0b\f\r"))


def normalized(value: Column) -> Column:
    return F.lower(stripped(value))


def without_accents(value: Column) -> Column:
    return F.translate(value, ACCENTED, PLAIN)


def recoded(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values; others, and NULL, pass through."""
    if not mapping:
        return value
    table = F.create_map(*[F.lit(item) for pair in mapping.items() for item in pair])
    return F.coalesce(table[value], value)


def first_number(value: Column) -> Column:
    """First run of digits and dots as DOUBLE, NULL if that is not a number."""
    return F.regexp_extract(value, r"([\d.]+)", 1).try_cast("double")


def mentions(value: Column, words: str) -> Column:
    return F.lower(value).contains(words.lower())


def is_email(value: Column, pattern: str = EMAIL_SIMPLE) -> Column:
    """False, not NULL, for a missing address."""
    return F.coalesce(value, F.lit("")).rlike(pattern)


def plain_markup(value: Column) -> Column:
    """Resolve the five predefined character references."""
    for reference, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        value = F.replace(value, F.lit(reference), F.lit(sign))
    return value
