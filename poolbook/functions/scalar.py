"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_day(ts: ColumnOrName) -> Column:
    """Calendar day of a timestamp as DATE.

    ``to_date`` works for TIMESTAMP (session zone, pinned to UTC) and for
    TIMESTAMP_NTZ alike, and yields a DATE that joins, partitions and
    compares the same way everywhere."""
    return F.to_date(_col(ts))


def scale_amount(raw: ColumnOrName, decimals: ColumnOrName) -> Column:
    """``raw / 10 ^ decimals`` in double precision (NULL decimals -> NULL)."""
    return _col(raw).cast("double") / F.pow(F.lit(10.0), _col(decimals))


def usd_value(raw: ColumnOrName, decimals: ColumnOrName, price: ColumnOrName) -> Column:
    """``raw / 10 ^ decimals * price``, evaluated left to right like the
    reference so that rounding is identical."""
    return scale_amount(raw, decimals) * _col(price)


def scale_weight(weight: ColumnOrName, one: int = 10**18) -> Column:
    """Fixed-point weight (``one`` = 100 %) to a double share.

    The division runs in decimal arithmetic (decimal(20,0) / decimal(19,0)
    gives decimal(38,18)) and is rounded to double once at the end."""
    num = _col(weight).cast("decimal(20,0)")
    den = F.lit(one).cast("decimal(19,0)")
    return (num / den).cast("double")


def concat_skip_null(*parts: ColumnOrName) -> Column:
    """Text concatenation that skips NULL parts (Spark's ``concat`` would
    return NULL as soon as one part is NULL)."""
    return F.concat_ws("", *[_col(p) for p in parts])


def byte_prefix(value: ColumnOrName, length: int) -> Column:
    """First ``length`` bytes of a binary (or characters of a string)."""
    return F.substring(_col(value), 1, length)


def hex_bytes(literal: str) -> Column:
    """Binary literal from a hex string such as ``'\\xAbC1...'`` or ``'0xab..'``;
    case-insensitive, so mixed-case addresses compare equal."""
    text = literal.lower()
    for prefix in ("\\x", "0x"):
        if text.startswith(prefix):
            text = text[len(prefix):]
    return F.unhex(F.lit(text))


def address_value(value, dtype):
    """A configured address for comparison with a column of ``dtype``: hex
    text ('0x..' or '\\x..', any case) becomes bytes for BINARY columns;
    anything else is passed through."""
    from pyspark.sql.types import BinaryType

    if isinstance(dtype, BinaryType) and isinstance(value, str):
        text = value.lower()
        for prefix in ("\\x", "0x"):
            if text.startswith(prefix):
                text = text[len(prefix):]
        return bytes.fromhex(text)
    return value


def replace_value(value: ColumnOrName, old: Column, new: Column) -> Column:
    """``CASE WHEN value = old THEN new ELSE value END``."""
    v = _col(value)
    return F.when(v == old, new).otherwise(v)
