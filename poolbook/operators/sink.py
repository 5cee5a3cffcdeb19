"""Keyed fact-table sink: insert-ignore with first-write-wins, and the
high-water mark / filled-window probes that drive refreshes."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from poolbook.functions.generators import _date


def _null_key(keys: list[str]):
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple, rows that
    tie there being ordered by their other columns.  Rows with a NULL key
    column are never duplicates of each other (SQL unique-key semantics): all
    of them are kept.

    One aggregate over one scan, partial map-side, so a key repeated a million
    times reaches the shuffle as one row per map partition.  Rows with a NULL
    key group by their whole content and come back as often as they were
    counted; where the schema forbids NULL keys that grouping is left out."""
    others = [c for c in batch.columns if c not in keys]
    ordered = [*dict.fromkeys(c for c in order if c in others), *[c for c in others if c not in order]]
    first = F.min(F.struct(*ordered) if ordered else F.lit(True)).alias("_row")
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns]
    nullable = [k for k in keys if batch.schema[k].nullable]
    if not nullable:
        return batch.groupBy(*keys).agg(first).select(*columns)
    content = F.when(_null_key(nullable), F.struct(*others) if others else F.lit(True))
    copies = F.when(_null_key(nullable), F.col("_n")).otherwise(1)
    return (batch.groupBy(*keys, content.alias("_content")).agg(first, F.count(F.lit(1)).alias("_n"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies.cast("bigint"))))
            .select(*columns))


def new_rows(batch: DataFrame, target: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K1 without the write: the rows insert-ignore would add -- first row per
    key by ``order``, minus keys already in ``target`` (plain ``=``: a NULL
    key matches nothing, so it is always new).  The batch is read once."""
    existing = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"_t_{k}")
        cond = c if cond is None else (cond & c)
    return first_per_key(batch, keys, order).join(existing, cond, "left_anti")


def insert_ignore(batch: DataFrame, path: str, target: DataFrame, keys: list[str], order: list[str],
                  partition_by: list[str] | None = None, cluster_by: list[str] | None = None) -> int:
    """K1 / K2: append the new rows of ``batch`` to the Parquet table at
    ``path`` and return how many were written.

    ``target`` is the stored table already pruned by the caller to the
    partitions the batch can touch (project, version, window months) so the
    anti join reads only those.  The count is observed on the write itself
    (no second pass).  Files are written per ``partition_by`` directory,
    clustered by ``cluster_by``.  First write wins: a recomputed row never replaces a
    stored one.  Single writer per table assumed."""
    rows = new_rows(batch, target, keys, order)
    if cluster_by:
        # Range-partition on the clustering columns (e.g. day, pool): tasks get
        # balanced, contiguous slices, and every file holds a narrow min/max
        # range for Parquet statistics.  Hash-partitioning on the directory
        # columns instead would send a whole month of a project to one task.
        rows = rows.repartitionByRange(*[F.col(c) for c in cluster_by]).sortWithinPartitions(*cluster_by)
    # Observe last: the range partitioner samples its input in a separate
    # job, and an observer below it would count the sampled rows too.
    obs = Observation("insert_ignore")
    writer = rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    written = _observed_count(obs)
    return rows.count() if written is None else written


def _observed_count(obs: Observation) -> int | None:
    """Rows counted by the observation; None if it has no metrics row.  That
    happens when adaptive execution finds the result empty and replaces the
    whole subtree, observer included, by an empty relation."""
    try:
        return int(obs.get["n"])
    except KeyError:
        return None
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getName() == "java.lang.AssertionError":
            return None
        raise


def high_water_mark(target: DataFrame, project: str | None = None, version: str | None = None,
                    day: str = "day"):
    """A2: latest stored day of a project/version (None when empty)."""
    t = target
    if project is not None:
        t = t.where(F.col("project") == project)
    if version is not None:
        t = t.where(F.col("version") == version)
    return t.agg(F.max(day)).first()[0]


def high_water_marks(target: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """A2 for every slice of a table: its latest stored day."""
    return target.groupBy(*keys).agg(F.max(day).alias("high_water_mark"))


def window_filled(target: DataFrame, start, end, project: str | None = None, version: str | None = None,
                  day: str = "day") -> bool:
    """Does the target hold any row of the project/version in
    ``[start, end)``?  (A partly filled window counts as filled.)"""
    t = target.where((F.col(day) >= F.lit(_date(start))) & (F.col(day) < F.lit(_date(end))))
    if project is not None:
        t = t.where(F.col("project") == project)
    if version is not None:
        t = t.where(F.col("version") == version)
    return not t.isEmpty()


def filled_windows(target: DataFrame, windows: DataFrame, length_days: int, origin,
                   keys: list[str], day: str = "day") -> DataFrame:
    """P13 for many windows at once: ``windows`` holds (keys..., window_start)
    of equal length; each gets ``filled``.  Stored rows are bucketed by
    window index so the test is an equi-join on (keys, index), not a range
    join."""
    o = F.lit(_date(origin))
    idx = F.floor(F.datediff(F.col(day), o) / F.lit(length_days)).cast("long")
    present = target.select(*keys, idx.alias("_idx")).distinct()
    w = windows.withColumn("_idx", F.floor(F.datediff(F.col("window_start"), o) / F.lit(length_days)).cast("long"))
    out = w.join(present.withColumn("_hit", F.lit(True)), [*keys, "_idx"], "left")
    return out.select(*windows.columns, F.coalesce(F.col("_hit"), F.lit(False)).alias("filled"))
