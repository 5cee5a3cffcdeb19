"""Windowed backfill and high-water-mark refresh of a daily fact table.

A stored table is Parquet partitioned by its scope columns (e.g. project,
version) and month; every write goes through insert-ignore, so reruns and
overlapping windows never duplicate or replace a stored row (first write
wins).  Each window's output is a written table, which is also what cuts the
lineage between windows: the next window reads its seed rows back from
storage, not from the previous plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.functions.generators import _date
from poolbook.operators import layout, sink
from poolbook.operators.fill import in_months
from poolbook.plans.config import REFRESH_END_LAG_MINUTES, REFRESH_OVERLAP_DAYS
from poolbook.schemas import LIQUIDITY_KEY, VIEW_LIQUIDITY_KEY
from poolbook.session import checkpoint

# (start, end, stored) -> rows of the window, not yet written
WindowJob = Callable[[object, object, DataFrame], DataFrame]


@dataclass(frozen=True)
class FactTable:
    """Where and how a daily fact table is stored.

    scope: column values that identify one job's slice of the table (for the
    liquidity fact: project and version); they are also directory partitions,
    followed by ``month`` derived from ``time_col``."""

    path: str
    row_schema: T.StructType
    keys: tuple[str, ...]
    time_col: str = "day"
    scope: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def partition_by(self) -> list[str]:
        return [*self.scope, "month"]


def liquidity_table(path: str, row_schema: T.StructType, project: str, version: str) -> FactTable:
    """K1 target: key (day, pool, token), one slice per project/version."""
    return FactTable(path, row_schema, tuple(LIQUIDITY_KEY), "day", {"project": project, "version": version},
                     order=("token_index", "token_amount_raw"), cluster_by=("day", "pool_address"))


def view_liquidity_table(path: str, row_schema: T.StructType) -> FactTable:
    """K2 target: key (block_time, pool, token), token may be NULL."""
    return FactTable(path, row_schema, tuple(VIEW_LIQUIDITY_KEY), "block_time", {},
                     order=("version", "token_amount_raw"), cluster_by=("block_time", "pool_address"))


def month_of(day_col: str = "day"):
    return F.date_format(F.col(day_col), "yyyy-MM")


def stored_table(spark: SparkSession, table: FactTable) -> DataFrame:
    """The stored table with the batch's row schema (plus ``month``), or an
    empty frame before the first write.  The schema is given explicitly so
    partition values keep their declared types (``version`` stays text)."""
    fields = list(table.row_schema.fields)
    if "month" not in table.row_schema.fieldNames():
        fields.append(T.StructField("month", T.StringType()))
    schema = T.StructType(fields)
    try:
        return spark.read.schema(schema).parquet(table.path)
    except Exception as exc:  # nothing written yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def _mine(stored: DataFrame, table: FactTable) -> DataFrame:
    out = stored
    for col, value in table.scope.items():
        out = out.where(F.col(col) == value)
    return out


def _prune(stored: DataFrame, table: FactTable, start, end) -> DataFrame:
    """Partition pruning: the job's scope and the months the window touches;
    the day filter then works on Parquet min/max statistics."""
    lo, hi = _date(start), _date(end)
    t = F.col(table.time_col)
    return in_months(_mine(stored, table), lo, hi - dt.timedelta(days=1)).where((t >= F.lit(lo)) & (t < F.lit(hi)))


def latest_day(stored: DataFrame, table: FactTable, before):
    """A2: the slice's latest stored day before the day ``before`` (None if
    there is none).  The month before it on is read first; only a table that
    ends earlier needs its older months."""
    lo = _date(before)
    mine = _mine(stored, table).where(F.col(table.time_col) < F.lit(lo))
    near = lo - dt.timedelta(days=31)
    recent = sink.high_water_mark(in_months(mine, near, lo), day=table.time_col)
    return recent if recent is not None else sink.high_water_mark(in_months(mine, None, near), day=table.time_col)


QUARANTINE = T.StructField("amount_text", T.StringType())


def quarantine_table(spark: SparkSession, table: FactTable) -> DataFrame:
    """Rows kept out of the fact because their raw amount has more than 38 digits: the
    fact's columns (that amount NULL), its text and the month."""
    fields = [*table.row_schema.fields, QUARANTINE, T.StructField("month", T.StringType())]
    path = f"{table.path.rstrip('/')}-quarantine"
    spark.createDataFrame([], T.StructType(fields)).write.mode("ignore").partitionBy("month").parquet(path)
    return spark.read.schema(T.StructType(fields)).parquet(path)


def write_window(rows: DataFrame, table: FactTable, stored: DataFrame, start, end) -> int:
    """Insert-ignore one window's rows, in the table's column types; returns
    the number of rows written.  Rows with an ``amount_text`` go to the quarantine
    table in the same way (rows that carry that column are computed once, for both)."""
    fields = list(table.row_schema.fields)
    if QUARANTINE.name in rows.columns:
        rows = checkpoint(rows)
        bad = rows.where(F.col(QUARANTINE.name).isNotNull())
        if not bad.isEmpty():
            kept = quarantine_table(rows.sparkSession, table)
            typed = bad.select(*[F.col(f.name).cast(f.dataType) for f in [*fields, QUARANTINE]]).withColumn("month", month_of(table.time_col))
            days = in_months(kept, _date(start), _date(end) - dt.timedelta(days=1))
            sink.insert_ignore(typed, f"{table.path.rstrip('/')}-quarantine", days, list(table.keys), list(table.order), partition_by=["month"])
        rows = rows.where(F.col(QUARANTINE.name).isNull())
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in fields])
    batch = typed.withColumn("month", month_of(table.time_col))
    return sink.insert_ignore(
        batch, table.path, _prune(stored, table, start, end), list(table.keys), list(table.order),
        partition_by=table.partition_by, cluster_by=list(table.cluster_by))


def window_filled(stored: DataFrame, table: FactTable, start, end) -> bool:
    return sink.window_filled(_prune(stored, table, start, end), start, end, day=table.time_col)


def backfill(spark: SparkSession, job: WindowJob, table: FactTable, windows: Iterable[tuple[object, object]],
             skip_filled: bool = True) -> list[int]:
    """Run windows oldest first; each is seeded from what the previous ones
    stored.  A window that already holds rows of the job's scope is skipped
    (a partly filled window counts as filled).  A window that would leave a
    gap after the stored rows is refused: its seeds would be missing."""
    counts = []
    for start, end in sorted(windows, key=lambda w: _date(w[0])):
        stored = stored_table(spark, table)
        if skip_filled and window_filled(stored, table, start, end):
            counts.append(0)
            continue
        latest_before = latest_day(stored, table, start)
        if latest_before is not None and latest_before < _date(start) - dt.timedelta(days=1):
            raise ValueError(f"window {start}..{end} would start after a gap: stored rows end {latest_before}")
        counts.append(write_window(job(start, end, stored), table, stored, start, end))
    return counts


def required_mark(stored: DataFrame, table: FactTable, as_of: dt.datetime) -> dt.date:
    """The high-water mark of the job's slice; a slice without rows is refused."""
    hwm = latest_day(stored, table, as_of.date() + dt.timedelta(days=1))
    if hwm is None:
        raise ValueError(f"no stored rows in {table.path} for {table.scope}: run a backfill first")
    return hwm


def refresh(spark: SparkSession, job: WindowJob, table: FactTable, as_of: dt.datetime,
            overlap_days: int = REFRESH_OVERLAP_DAYS, lag_minutes: int = REFRESH_END_LAG_MINUTES) -> int:
    """Recompute from ``high-water mark - overlap_days`` to the last finished
    day before ``as_of - lag``; only missing keys are written."""
    stored = stored_table(spark, table)
    hwm = required_mark(stored, table, as_of)
    start = hwm - dt.timedelta(days=overlap_days)
    end = (as_of - dt.timedelta(minutes=lag_minutes)).date()  # finished days only
    if end <= start:
        return 0
    return write_window(job(start, end, stored), table, stored, start, end)


def compact(spark: SparkSession, table: FactTable, months: list[str], files_per_month: int | None = None,
            file_bytes: int = layout.FILE_BYTES) -> int:
    """Rewrite the given month partitions of the job's slice (frequent refreshes leave
    many small files), each in files of about ``file_bytes`` (or ``files_per_month`` of
    them) along a space-filling curve over the key, so that a filter on day, pool or
    token skips most files.  Rows are first checkpointed into the shared checkpoint
    folder, so the overwrite never reads from its own target; only the listed partitions
    are replaced (dynamic partition overwrite).  Returns the number of rows rewritten."""
    done = 0
    for month in months:
        part = _mine(stored_table(spark, table), table).where(F.col("month") == month)
        snap = checkpoint(part)
        n = snap.count()
        if n == 0:
            continue
        folder = "/".join([table.path.rstrip("/"), *(f"{k}={v}" for k, v in table.scope.items()), f"month={month}"])
        files = files_per_month or layout.files_for(spark, [folder], file_bytes)
        out = layout.along_curve(snap, list(table.keys), files)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*table.partition_by).parquet(table.path))
        done += n
    return done
