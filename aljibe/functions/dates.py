"""Dates, calendar attributes and load windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed_date(value: Column) -> Column:
    """Date from text, date or timestamp; NULL where it does not parse."""
    return value.cast("string").try_cast("timestamp_ntz").cast("date")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of one date, in the column order of the time dimension."""
    day_name = F.date_format(day, "EEEE")
    return {
        "date_key": date_key(day),
        "date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.day(day),
        "day_name": day_name,
        "week_of_year": F.weekofyear(day),
        "is_weekend": day_name.isin("Saturday", "Sunday"),
    }


def yesterday(as_of_utc: Column, zone: str = "-05:00") -> Column:
    """The day before ``as_of_utc`` as seen in ``zone``."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(as_of_utc, zone)), 1)


def in_window(moment: Column, start: Column, end: Column) -> Column:
    """start < moment <= end. Written so that both bounds reach the scan."""
    return (moment > start) & (moment <= end)
