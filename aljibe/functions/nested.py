"""Arrays, maps and JSON text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Keys under which a conversation document may hold its messages, in order of preference.
MESSAGE_KEYS = ("messages", "transcript", "conversation", "turns")


def comparable_map(value: Column) -> Column:
    """A map as sorted key/value pairs, so that rows can be compared and deduplicated."""
    return F.array_sort(F.map_entries(value))


def joined(items: Column, separator: str = ",") -> Column:
    """Array as text; NULL items are skipped."""
    return F.array_join(items.cast("array<string>"), separator)


def first_list(document: Column, item_type: str, keys: Sequence[str] = MESSAGE_KEYS) -> Column:
    """Array under the first of ``keys`` that holds a list in a JSON document."""
    # a field holding something other than a list parses as NULL
    schema = ", ".join(f"`{key}` array<{item_type}>" for key in keys)
    parsed = F.from_json(document, schema)
    return F.coalesce(*[parsed[key] for key in keys])


def failing(named_checks: Sequence[tuple[str, Column]]) -> Column:
    """Names whose condition holds, as an array without gaps."""
    names = F.array(*[F.when(condition, F.lit(name)) for name, condition in named_checks])
    return F.filter(names, lambda name: name.isNotNull())


def mapped_filtered_reduced(
    items: Column,
    change: Callable[[Column], Column],
    keep: Callable[[Column], Column],
    combine: Callable[[Column, Column], Column],
    start: Column,
) -> Column:
    """map, filter and reduce over one row's array."""
    return F.aggregate(F.filter(F.transform(items, change), keep), start, combine)


def map_total(value: Column) -> Column:
    """Sum of the non-NULL values of a numeric map."""
    return F.aggregate(
        F.map_values(value), F.lit(0.0), lambda total, item: total + F.coalesce(item.cast("double"), F.lit(0.0))
    )


def array_mean(items: Column) -> Column:
    """Mean of a numeric array's non-NULL items, NULL where there are none."""
    present = F.filter(items, lambda item: item.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda so_far, item: so_far + item.cast("double"))
    return total / F.nullif(F.size(present), F.lit(0))
