"""Days that should have landed and did not."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F


def missing_ranges(landed: DataFrame, day: str, start: date | None = None, end: date | None = None, by: Sequence[str] = ()) -> DataFrame:
    """First day, last day and length of each gap in [start, end], per value of ``by`` if given.

    Without ``start`` or ``end`` the first or last day of the table is read in the same plan, as a one-row aggregate; a table without days has no gaps.
    A value of ``by`` with rows outside [start, end] only is one gap. ``landed`` is reduced to distinct days
    per task before it is shuffled, so the window of a value holds its calendar days at most,
    and the result has a row per gap, not per day.
    """
    start, end = [landed.agg(of(day)).scalar() if at is None else F.lit(at) for at, of in ((start, F.min), (end, F.max))]
    inside = F.col(day).between(start, end)
    present = landed.select(*by, F.when(inside, F.col(day)).alias("_day")).distinct()
    stop = F.date_add(end, 1).alias("_day")
    keys = landed.select(*by).distinct() if by else landed.sparkSession.range(1)
    edges = present.where("_day is not null").unionByName(keys.select(*by, stop))
    before = F.lag("_day", 1).over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("_day"))
    gaps = edges.withColumn("_from", F.date_add(F.coalesce(before, F.date_sub(start, 1)), 1))
    length = F.datediff("_day", "_from")
    return gaps.where(length > 0).select(*by, F.col("_from").alias("first_day"), F.date_sub("_day", 1).alias("last_day"), length.alias("n_days"))
