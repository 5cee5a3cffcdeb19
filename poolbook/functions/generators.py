"""Generators: calendars, day spans, lock-step array explode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def calendar(spark: SparkSession, start, end, name: str = "day") -> DataFrame:
    """One DATE row per day in ``[start, end)``; empty (not an error) when
    ``end <= start``.  Built from ``range`` so no bound check can throw."""
    first, stop = _date(start), _date(end)
    n = max((stop - first).days, 0)
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def day_span(first_day: Column, next_day: Column, start, end) -> Column:
    """Days ``d`` with ``first_day <= d < next_day`` clipped to ``[start, end)``,
    as an array, or NULL when the clipped span is empty.

    Exploding this replaces the range join ``calendar.day BETWEEN first AND
    next`` (a nested-loop join) by a narrow generator."""
    lo = F.greatest(first_day, F.lit(_date(start)))
    hi = F.date_sub(F.least(next_day, F.lit(_date(end))), 1)
    known = first_day.isNotNull() & next_day.isNotNull()  # least and greatest skip NULLs
    return F.when(known & (lo <= hi), F.sequence(lo, hi))


def zip_explode(df: DataFrame, keep: list[str], arrays: dict[str, Column]) -> DataFrame:
    """Lock-step explode of several arrays: row ``i`` takes element ``i`` of
    every array, shorter arrays pad with NULL, a NULL array counts as empty.

    (Two ``explode`` calls in one select would form a cross product.)"""
    names = list(arrays)
    padded = []
    for c in arrays.values():
        padded.append(F.coalesce(c, F.array()))
    zipped = df.select(*keep, F.inline(F.arrays_zip(*padded)))
    return zipped.toDF(*keep, *names)
