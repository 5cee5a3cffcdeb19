"""File layout of a stored table: rows along a space-filling curve.

Sorting by (day, pool, token) gives every file a narrow range of days and a wide one
of pools and tokens, so a look-up by pool or token opens all files.  Here each column
is cut into 2^BITS ranges of about equal row counts, and the bits of the three range
numbers are interleaved (Z-order): neighbouring rows are close in all columns, and a
filter on any one of them skips most files by their min/max statistics.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 5
#: Intended bytes of a data file.
FILE_BYTES = 256 << 20


def order_number(column: str, kind: T.DataType) -> Column:
    """A number that orders values like the column itself, or coarser: the first six
    bytes of text and binary, the day of dates."""
    c = F.col(column)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.substring(F.hex(c), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("double")


def _place(number: Column, bounds: list) -> Column:
    """How many bounds a number has reached (0 for NULL)."""
    reached = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= number)) if bounds else F.lit(0)
    return F.coalesce(reached, F.lit(0)).cast("bigint")


def along_curve(rows: DataFrame, columns: list[str], files: int) -> DataFrame:
    """``rows`` in ``files`` ranges of the curve over ``columns``, sorted by it.  The
    range bounds are approximate quantiles: 2^BITS - 1 numbers a column on the driver."""
    numbers = [order_number(c, rows.schema[c].dataType) for c in columns]
    shares = F.array(*[F.lit(i / 2**BITS) for i in range(1, 2**BITS)])
    found = rows.agg(*[F.percentile_approx(n, shares).alias(f"b{i}") for i, n in enumerate(numbers)]).first()
    curve = F.lit(0).cast("bigint")
    for i, number in enumerate(numbers):
        bounds = sorted(set(found[f"b{i}"] or []))
        place = _place(number, bounds)
        for bit in range(BITS):
            spread = F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(columns) + i)
            curve = curve.bitwiseOR(spread)
    order = [F.col("_curve"), *[F.col(c) for c in columns]]
    placed = rows.withColumn("_curve", curve)
    return placed.repartitionByRange(max(files, 1), *order).sortWithinPartitions(*order).drop("_curve")


def files_for(spark: SparkSession, paths: list[str], file_bytes: int = FILE_BYTES) -> int:
    """Files of ``file_bytes`` that the stored bytes of ``paths`` make (names and
    lengths are listed; no content is read)."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
    size = listed.agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(size / file_bytes))
