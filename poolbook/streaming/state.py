"""Derived state kept between runs.

``MarkedTable``: rows that only ever come in (members of pools, known pools), with
a high-water mark.  An extension derives candidates from the source rows after the
mark alone, keeps those not stored yet (anti join) and moves the mark.  Rows are
written before the mark, so a run that dies in between is simply repeated: its rows
are found again and left out.

``SnapshotTable``: the whole state as of a day (closing balances, a slice of pool
names), one folder a day; the day is recorded only after the folder is complete, so
readers never see half a snapshot.  A repeated write of a day replaces its folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.functions.generators import _date
from poolbook.operators import pools as P
from poolbook.operators.fill import in_window, ts_literal
from poolbook.operators.sink import _observed_count

_MARKS = T.StructType([T.StructField("upto", T.DateType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet rows at ``path``; a table that does not exist yet is created empty."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class _Marked:
    path: str
    row_schema: T.StructType

    def _days(self, spark: SparkSession) -> DataFrame:
        return _read(spark, f"{self.path}/marks", _MARKS)

    def mark(self, spark: SparkSession, before=None) -> dt.date | None:
        """The latest recorded day (before ``before``, if given)."""
        days = self._days(spark)
        if before is not None:
            days = days.where(F.col("upto") < F.lit(_date(before)))
        return days.agg(F.max("upto")).first()[0]

    def _record(self, spark: SparkSession, day: dt.date) -> None:
        spark.createDataFrame([(day,)], _MARKS).coalesce(1).write.mode("append").parquet(f"{self.path}/marks")


class MarkedTable(_Marked):
    """Rows unique by all their columns, complete up to the mark (exclusive)."""

    def rows(self, spark: SparkSession) -> DataFrame:
        return _read(spark, f"{self.path}/rows", self.row_schema)

    def extend(self, spark: SparkSession, rows_between: Callable[[dt.date | None, dt.date], DataFrame], end) -> int:
        """Add the rows that ``rows_between(mark, end)`` yields and that are not
        stored; returns how many.  Rows with a NULL match nothing and are left out."""
        end, since = _date(end), self.mark(spark)
        if since is not None and since >= end:
            return 0
        names = self.row_schema.fieldNames()
        fresh = rows_between(since, end).select(*[F.col(f.name).cast(f.dataType) for f in self.row_schema.fields])
        fresh = fresh.dropna(subset=names).distinct().join(self.rows(spark), names, "left_anti")
        seen = Observation()
        fresh.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{self.path}/rows")
        self._record(spark, end)
        return _observed_count(seen) or 0


class SnapshotTable(_Marked):
    """The state at the close of a day."""

    def write(self, rows: DataFrame, day) -> None:
        day = _date(day)
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.row_schema.fields])
        typed.write.mode("overwrite").parquet(f"{self.path}/closing={day}")
        self._record(rows.sparkSession, day)

    def latest(self, spark: SparkSession, before=None) -> tuple[dt.date, DataFrame] | None:
        """(day, rows) of the latest snapshot (before ``before``); only its folder is read."""
        day = self.mark(spark, before)
        return None if day is None else (day, spark.read.schema(self.row_schema).parquet(f"{self.path}/closing={day}"))


# ---- pool-token membership (C10, U3) -------------------------------------------
def _between(df: DataFrame, ts: str, since, end) -> DataFrame:
    if since is None:
        return df.where(F.col(ts) < ts_literal(df, ts, end))
    return in_window(df, ts, since, end)


def extend_trade_members(spark: SparkSession, members: MarkedTable, trades: DataFrame, end, pool: str, token_a: str,
                         token_b: str, ts: str) -> int:
    """U3 kept as state: (pool, token) of both sides of every trade before ``end``;
    reads only the trades after the mark."""
    return members.extend(spark, lambda since, stop: P.pair_union_distinct(_between(trades, ts, since, stop), pool, token_a, token_b), end)


def extend_transfer_members(spark: SparkSession, members: MarkedTable, known: MarkedTable, transfers: DataFrame,
                            registry: DataFrame, end, to: str = "to", token: str = "contract_address",
                            ts: str = "evt_block_time", registered: str | None = None) -> int:
    """C10 kept as state: tokens that registered pools received before ``end``.

    Reads only the transfers after the mark.  A pool that was not known at the mark
    may have received tokens before: its older transfers are read once, unless the
    registry's ``registered`` time says that it did not exist then.  ``registry`` has
    the column ``pool``; ``known`` keeps the pools seen so far."""
    late = None
    since = members.mark(spark)
    if since is not None:
        unseen = registry.dropna(subset=["pool"]).join(known.rows(spark), "pool", "left_anti")
        if registered is not None:
            unseen = unseen.where(F.col(registered).isNull() | (F.col(registered) < ts_literal(registry, registered, since)))
        late = None if unseen.isEmpty() else unseen

    def between(mark, stop) -> DataFrame:
        fresh = P.tokens_seen(_between(transfers, ts, mark, stop), registry, to, token)
        if late is not None:
            fresh = fresh.unionByName(P.tokens_seen(_between(transfers, ts, None, mark), late, to, token))
        return fresh

    added = members.extend(spark, between, end)
    known.extend(spark, lambda mark, stop: registry.select("pool"), end)
    return added


# ---- pool names (K3, C8) ---------------------------------------------------------
def refresh_labels(spark: SparkSession, known: MarkedTable, names: SnapshotTable, registry: DataFrame,
                   name_pools: Callable[[DataFrame], DataFrame], end, ts: str) -> int:
    """K3 kept as state: one slice (a project's pools) of the label store.

    ``known`` holds the pool and token columns of the registry; only registry rows
    after its mark are read.  ``name_pools`` names all known pools from the token
    dimension of today, so a changed symbol reaches old pools too, and the slice
    ``names`` is replaced as a whole.  Returns the registry rows added."""
    columns = known.row_schema.fieldNames()
    added = known.extend(spark, lambda since, stop: _between(registry, ts, since, stop).select(*columns), end)
    names.write(name_pools(known.rows(spark)).distinct(), end)
    return added


def stored_labels(spark: SparkSession, names: SnapshotTable) -> DataFrame:
    """The label set (address, label, type, author) of a stored slice."""
    last = names.latest(spark)
    if last is None:
        raise ValueError(f"no label slice in {names.path}: refresh it first")
    return last[1]
