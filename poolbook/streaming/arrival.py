"""Refresh on arrival: Structured Streaming as the trigger of C3.

The reference polls on a schedule.  Here a file stream over the change log's
folder detects new files; for every micro-batch, ``foreachBatch`` runs one
window of the job and insert-ignores it into the fact table.  The
micro-batch only decides *which days* to recompute -- from the earlier of
(high-water mark - overlap) and the earliest newly arrived change -- while
the job itself reads the full inputs with pushdown, so results equal a
batch refresh.  Stream progress (which files were seen) is kept in a
checkpoint folder under ``spark.checkpoint.dir``; a batch that fails is
retried, and insert-ignore makes the retry idempotent.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.plans.config import REFRESH_END_LAG_MINUTES, REFRESH_OVERLAP_DAYS
from poolbook.session import checkpoint_dir
from poolbook.streaming.polling import FactTable, WindowJob, required_mark, stored_table, write_window


def refresh_on_arrival(
    spark: SparkSession,
    job: WindowJob,
    table: FactTable,
    changes_path: str,
    changes_schema: T.StructType,
    ts_col: str = "timestamp",
    name: str = "refresh",
    available_now: bool = True,
    interval: str = "10 minutes",
    overlap_days: int = REFRESH_OVERLAP_DAYS,
    lag_minutes: int = REFRESH_END_LAG_MINUTES,
    now=None,
):
    """Start the stream; returns the ``StreamingQuery``.  The table must hold a
    backfilled window: an empty one is refused, as by ``polling.refresh``.

    ``available_now=True`` processes what has arrived and stops (one
    scheduled run); otherwise it keeps running every ``interval``.  ``now``
    (a callable returning a datetime) fixes the clock for tests."""
    clock = now or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    required_mark(stored_table(spark, table), table, clock())

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        earliest = batch.agg(F.min(F.col(ts_col))).first()[0]
        if earliest is None:
            return
        stored = stored_table(spark, table)
        hwm = required_mark(stored, table, clock())
        start = earliest.date() if hasattr(earliest, "date") else earliest
        start = min(start, hwm - dt.timedelta(days=overlap_days))
        end = (clock() - dt.timedelta(minutes=lag_minutes)).date()  # finished days only
        if end > start:
            write_window(job(start, end, stored), table, stored, start, end)

    stream = spark.readStream.schema(changes_schema).parquet(changes_path).select(ts_col)
    writer = (stream.writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "streams", name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
