"""Scans along an order that may be very uneven: prefix sums and as-of look-ups.

A window partitioned by a key puts all rows of the key into one task.  Here rows
are range-partitioned by (key, order), so a key with a third of all rows is spread
over a third of the ranges:

1. ``ranged`` sorts the rows into ranges once and writes them (a reliable
   checkpoint: later steps see the same ranges, also after a lost executor);
2. each range is reduced to one value per key, and these few rows are scanned over
   the ranges to give what comes in from earlier ones.  Only the first key of a range
   can have rows in an earlier one, so that table has at most one row a range: its
   broadcast is bounded by the number of ranges;
3. a window inside (range, key) does the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolbook.session import checkpoint

RANGE = "_range"
#: Ranges for each task of the local pass: neighbouring ones are dealt together, evenly.
RANGES_PER_TASK = 8


def _tasks(df: DataFrame, tasks: int | None) -> int:
    return tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, keys: list[str], order: list[Column], tasks: int | None = None) -> DataFrame:
    """``df`` in ranges of (keys, order), numbered in ``_range``, written once."""
    n = _tasks(df, tasks) * RANGES_PER_TASK
    placed = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(RANGE, F.spark_partition_id())
    return checkpoint(placed)


def _dealt(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Whole ranges dealt to tasks: a window by (range, key) needs no other exchange."""
    return rows.repartitionByRange(_tasks(rows, tasks), RANGE)


def _incoming(per_range: DataFrame, keys: list[str], value: str, scan) -> DataFrame:
    """What earlier ranges hand to a (range, key): at most one row a range."""
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_in{i}") for i, k in enumerate(keys)]
    return per_range.select(F.col(RANGE).alias("_in_range"), *named, scan(F.col(value)).over(earlier).alias("_incoming")).where(
        F.col("_incoming").isNotNull())


def _with_incoming(rows: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    same = F.col(RANGE) == F.col("_in_range")
    for i, k in enumerate(keys):  # a NULL key is a key like any other
        same = same & F.col(k).eqNullSafe(F.col(f"_in{i}"))
    return rows.join(F.broadcast(incoming), same, "left")


def running_sum(df: DataFrame, keys: list[str], ts: str, delta: str, frame: str = "range", tie: str | None = None,
                out: str = "amount_raw", tasks: int | None = None) -> DataFrame:
    """Running SUM of ``delta`` per key by ``ts``.  ``frame="range"``: rows of
    equal ``ts`` share one total and stay in one range; ``frame="rows"``: stepwise, ties
    by ``tie``, then by a hash of the row.  NULL only while nothing but NULLs came."""
    order = [F.col(ts)]
    if frame == "rows":
        order += [F.col(tie)] if tie else []
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    rows = ranged(df, keys, order, tasks)
    per_range = rows.groupBy(RANGE, *keys).agg(F.sum(delta).alias("_total"))
    within = Window.partitionBy(RANGE, *keys).orderBy(*order)
    upto = (within.rangeBetween if frame == "range" else within.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    local = _dealt(rows, tasks).withColumn("_within", F.sum(delta).over(upto))
    both = _with_incoming(local, _incoming(per_range, keys, "_total", F.sum), keys)
    total = F.coalesce(F.col("_incoming") + F.col("_within"), F.col("_incoming"), F.col("_within"))
    return both.select(*df.columns, total.alias(out))


def asof_join(left: DataFrame, right: DataFrame, keys: dict[str, str], left_time: str, right_time: str, values: list[str],
              tasks: int | None = None) -> DataFrame:
    """``left`` with the ``values`` of the latest ``right`` row of the same key
    at or before ``left_time`` (NULL if there is none).  ``keys``: left -> right columns.

    Both sides are merged in (key, time) order and the last values are carried on; no
    row is made per key and day.  Of several right rows of one key and time the largest
    ``values`` count; a NULL key or time on the right matches nothing."""
    names = [f"_k{i}" for i in range(len(keys))]
    priced = (right.dropna(subset=[*keys.values(), right_time])
              .groupBy(*[F.col(c).alias(n) for c, n in zip(keys.values(), names)], F.col(right_time).alias("_time"))
              .agg(F.max(F.struct(*values)).alias("_value")))
    asking = left.select(*[F.col(c).alias(n) for c, n in zip(keys, names)], F.col(left_time).alias("_time"),
                         F.struct(*left.columns).alias("_left"))
    merged = asking.unionByName(priced, allowMissingColumns=True)
    order = [F.col("_time"), F.col("_left").isNotNull(), F.xxhash64("_left")]
    rows = ranged(merged, names, order, tasks)
    # Ranges without a value of their own hand on what came in: they are in the scan too.
    per_range = rows.groupBy(RANGE, *names).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_time"))).alias("_carried"))
    upto = Window.partitionBy(RANGE, *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = _dealt(rows, tasks).withColumn("_within", F.last("_value", ignorenulls=True).over(upto)).where(F.col("_left").isNotNull())
    both = _with_incoming(local, _incoming(per_range, names, "_carried", lambda c: F.last(c, ignorenulls=True)), names)
    found = F.coalesce("_within", "_incoming")
    return both.select("_left.*", *[found[v].alias(v) for v in values])
