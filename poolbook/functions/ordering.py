"""Ordering keys for "last change of the day" aggregation.

``max_by(value, key)`` stays in a hash aggregate (with map-side partial
aggregation) only if ``key`` is a fixed-width mutable type.  A struct key
(timestamp, tie-break) falls back to a sort aggregate, so a composite order
is packed into one DECIMAL(38,0):

    micros since the row's midnight (<= 8.64e10) * 10^21
  + source rank (0..9)                          * 10^20
  + tie-break long shifted to be non-negative   (< 1.9e19)

which orders exactly like (timestamp, rank, tie) within a day.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 2**63


def _dec(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(38,0)")


def change_order(ts: Column, day: Column, rank: Column | None = None, tie: Column | None = None) -> Column:
    """Ordering key of a change inside its day; ``ts`` alone when there is
    neither a rank nor a tie-break."""
    if rank is None and tie is None:
        return ts
    micros = F.timestamp_diff("MICROSECOND", day.cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    key = micros.cast("decimal(38,0)") * _dec(10**21)
    if rank is not None:
        key = key + rank.cast("decimal(38,0)") * _dec(10**20)
    if tie is not None:
        tie = F.coalesce(tie.cast("decimal(38,0)"), _dec(0))
        key = key + (tie + _dec(_SHIFT))
    return key.cast("decimal(38,0)")
