"""Freshness: the reference keeps its fact tables current by polling
(scheduled backfill windows and a refresh from the high-water mark), not by
a stream.  ``polling`` re-expresses that as batch jobs over stored Parquet
tables; any scheduler can call it."""

from poolbook.streaming.arrival import refresh_on_arrival
from poolbook.streaming.polling import (
    FactTable,
    backfill,
    compact,
    liquidity_table,
    month_of,
    refresh,
    stored_table,
    view_liquidity_table,
)

__all__ = ["FactTable", "backfill", "compact", "refresh_on_arrival", "liquidity_table", "month_of", "refresh", "stored_table", "view_liquidity_table"]
