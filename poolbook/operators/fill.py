"""Daily forward-fill of sparse state changes and its seeded variants.

The reference closes each state's validity interval with ``lead`` over the
raw change log and range-joins the intervals with a calendar.  Here:

1. ``compact_daily``   keep the last change of each key and day
                       (hash aggregate, partial map-side: a key with millions
                       of changes shrinks to one row per day before any
                       shuffle, so a hot pool cannot skew a task);
2. ``close_intervals`` ``lead(day)`` per key over the compacted rows (at most
                       one row per key and day in each window partition);
3. ``expand_days``     explode the clipped day span -- a narrow generator
                       instead of a nested-loop range join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolbook.functions.generators import _date, calendar, day_span
from poolbook.functions.ordering import change_order
from poolbook.session import checkpoint


def compact_daily(
    changes: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    rank: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """One row per (keys, day): the value of the day's last change, ordered by
    ``ts``, then ``rank``, then ``tie``."""
    day = F.to_date(F.col(ts))
    order = change_order(
        F.col(ts),
        day,
        F.col(rank) if rank else None,
        F.col(tie) if tie else None,
    )
    return (
        changes.withColumn("day", day)
        .groupBy(*keys, "day")
        .agg(F.max_by(F.col(value), order).alias(value))
    )


def close_intervals(daily: DataFrame, keys: list[str], end, name: str = "next_day") -> DataFrame:
    """Add the day of the key's next change; the last state is open until
    ``end`` (an explicit as-of date instead of ``now()``)."""
    w = Window.partitionBy(*keys).orderBy("day")
    return daily.withColumn(name, F.lead("day", 1, _date(end)).over(w))


def expand_days(intervals: DataFrame, start, end, next_col: str = "next_day") -> DataFrame:
    """Replace each [day, next_day) interval by one row per covered day in
    ``[start, end)``."""
    span = day_span(F.col("day"), F.col(next_col), start, end)
    cols = [c for c in intervals.columns if c not in ("day", next_col)]
    return intervals.select(F.explode(span).alias("day"), *cols)


def forward_fill_daily(
    changes: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    start,
    end,
    rank: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """One row per key and day in ``[start, end)`` from the key's first
    change on, holding the last value known at the end of that day.

    Changes at or after ``end`` cannot affect any output day and are dropped
    before the aggregation (the filter reaches the scan)."""
    return expand_days(daily_intervals(changes, keys, value, ts, end, rank=rank, tie=tie), start, end)


def daily_intervals(
    changes: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    end,
    rank: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """C1 before the day expansion: one row per key and day with a change,
    valid on [day, next_day).  Joins that do not depend on the day (token
    dimension, pool name) are cheaper here than on the expanded rows."""
    relevant = changes.where(F.col(ts) < ts_literal(changes, ts, end))
    daily = compact_daily(relevant, keys, value, ts, rank=rank, tie=tie)
    return close_intervals(daily, keys, end)


def in_window(changes: DataFrame, ts: str, start, end) -> DataFrame:
    """Half-open time filter ``start <= ts < end`` (P2); pushed to Parquet."""
    t = F.col(ts)
    return changes.where((t >= ts_literal(changes, ts, start)) & (t < ts_literal(changes, ts, end)))


def ts_literal(df: DataFrame, ts: str, day) -> Column:
    """Midnight of ``day`` as a literal of the column's own type (DATE,
    TIMESTAMP or TIMESTAMP_NTZ), so comparisons stay on the bare column and
    reach the Parquet scan as pushed filters."""
    return F.lit(_date(day)).cast(df.schema[ts].dataType)


def in_months(stored: DataFrame, first=None, last=None) -> DataFrame:
    """Partition pruning of a stored table: only the months (``yyyy-MM`` in
    its ``month`` column, if it has one) of the days ``first`` to ``last``."""
    if "month" not in stored.columns:
        return stored
    if first is not None:
        stored = stored.where(F.col("month") >= _date(first).strftime("%Y-%m"))
    if last is not None:
        stored = stored.where(F.col("month") <= _date(last).strftime("%Y-%m"))
    return stored


def seed_rows(
    stored: DataFrame,
    start,
    lookback_days: int = 3,
    day: str = "day",
    mode: str = "lookback",
) -> DataFrame:
    """Stored output rows that restart a window from saved state.
    A table with a ``month`` column is read from the first month needed on.

    ``mode="lookback"``: rows with ``day >= start - lookback_days`` (the
    reference re-reads a few days in case the previous run was incomplete).
    ``mode="latest"``: the rows of the latest stored day (all ties kept),
    found with a scalar max -- one tiny aggregate, broadcast back.
    """
    if mode == "lookback":
        lo = _date(start) - dt.timedelta(days=lookback_days)
        return in_months(stored, lo).where(F.col(day) >= F.lit(lo))
    if mode == "latest":
        if "month" in stored.columns:  # the newest month first: only it is searched for its last day
            newest = stored.agg(F.max("month")).first()[0]
            stored = stored.where(F.col("month") == F.lit(newest))
        latest = stored.agg(F.max(day).alias("_latest_day"))
        return stored.join(F.broadcast(latest), F.col(day) == F.col("_latest_day")).drop("_latest_day")
    raise ValueError(f"unknown seed mode {mode!r}")


def after_latest(changes: DataFrame, ts: str, stored: DataFrame, day: str = "day") -> DataFrame:
    """Changes strictly after the midnight of the latest stored day, a scalar
    subquery (no rows while nothing is stored, as NULL compares to nothing)."""
    latest = stored.agg(F.max(day)).scalar()
    return changes.where(F.col(ts) > latest.cast(changes.schema[ts].dataType))


def seeded_changes(
    changes: DataFrame,
    seeds: DataFrame,
    ts: str,
    value: str,
    seed_day: str = "day",
    seed_value: str | None = None,
) -> DataFrame:
    """Union new changes with seed rows stamped at their day's midnight.

    Seeds get rank 0 and changes rank 1, so a change at exactly midnight of a
    seeded day wins over the stored state.  The union is by name; the seed
    columns are renamed to the change-log columns first."""
    ts_type = changes.schema[ts].dataType.simpleString()
    renamed = seeds.withColumnRenamed(seed_value or value, value)
    cols = []
    for f in changes.schema.fields:
        if f.name == ts:
            cols.append(F.col(seed_day).cast(ts_type).alias(ts))
        elif f.name in renamed.columns:
            cols.append(F.col(f.name).cast(f.dataType))
        else:  # e.g. the change log's tie-break column: irrelevant for seeds
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    seed = renamed.select(*cols)
    return changes.withColumn("_src_rank", F.lit(1)).unionByName(seed.withColumn("_src_rank", F.lit(0)))


#: Days that one number of a coverage bitmap holds.
BITMAP_DAYS = 62


def covered_days(intervals: DataFrame, start, end, next_col: str = "next_day") -> set[dt.date]:
    """Days of ``[start, end)`` inside some interval: one pass, in which every
    interval sets its bits in a bitmap of the calendar (OR-ed map-side)."""
    first = _date(start)
    n = max((_date(end) - first).days, 0)
    offset = lambda c: F.datediff(F.col(c), F.lit(first))
    power = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k.cast("int"))
    words = []
    for at in range(0, n, BITMAP_DAYS):
        size = min(BITMAP_DAYS, n - at)
        lo, hi = (F.least(F.greatest(offset(c) - at, F.lit(0)), F.lit(size)) for c in ("day", next_col))
        words.append(F.bit_or(F.when(hi > lo, power(hi) - power(lo)).otherwise(F.lit(0).cast("bigint"))))
    bits = intervals.agg(*words).first() if words else []
    return {first + dt.timedelta(days=i * BITMAP_DAYS + k) for i, w in enumerate(bits) for k in range(BITMAP_DAYS) if (w or 0) >> k & 1}


def calendar_left_fill(intervals: DataFrame, start, end, next_col: str = "next_day") -> DataFrame:
    """Calendar LEFT JOIN intervals on ``day <= c.day < next_day``.

    Days covered by some interval get one row per covering interval; days
    covered by none get a single row of NULLs.  The intervals are written once
    (checkpoint), so their sources are read once; a bitmap of the covered days comes
    from there, and the plan is the expansion and a literal of the other days."""
    intervals = checkpoint(intervals.dropna(subset=["day", next_col]))
    spark = intervals.sparkSession
    covered = expand_days(intervals, start, end, next_col)
    present = covered_days(intervals, start, end, next_col)
    days = calendar(spark, start, end)
    empty_days = days.where(~F.col("day").isin(present)) if present else days
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in covered.schema.fields if f.name != "day"]
    return covered.unionByName(empty_days.select("day", *nulls))
