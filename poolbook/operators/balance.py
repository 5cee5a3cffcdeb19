"""Balances from signed deltas: daily sums, running balances with an opening
balance, net flows of member wallets, and the vault delta union."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.functions import wide
from poolbook.functions.generators import _date, zip_explode
from poolbook.operators.fill import in_months, in_window, ts_literal
from poolbook.operators.scan import running_sum


def daily_deltas(events: DataFrame, keys: list[str], ts: str, delta: str, out: str = "delta_amount") -> DataFrame:
    """A5 + A7: ``SUM(COALESCE(delta, 0))`` per (day, keys); partial
    aggregation map-side, exact for decimals and for text amounts of up to 78
    digits (an all-NULL group gives 0)."""
    kind = events.schema[delta].dataType
    return events.groupBy(F.to_date(ts).alias("day"), *keys).agg(
        wide.total(F.coalesce(F.col(delta), wide.zero(kind)), kind).alias(out))


def running_balance_events(deltas: DataFrame, keys: list[str], ts: str, delta: str, frame: str = "range",
                           tie: str | None = None, out: str = "amount_raw", tasks: int | None = None) -> DataFrame:
    """W4 / W5 at event grain: running SUM of ``delta`` per key ordered by
    ``ts``.  ``frame="range"``: rows with equal ``ts`` share one total (SQL's
    default frame); ``frame="rows"``: stepwise, ties broken by ``tie``.  A busy key,
    and a busy day of it, is spread over many tasks (``scan.running_sum``)."""
    return running_sum(deltas, keys, ts, delta, frame, tie, out, tasks)


def opening_balance(stored: DataFrame, start, time_col: str = "block_time",
                    keys: tuple[str, ...] = ("pool_address", "token_address"),
                    amount: str = "token_amount_raw", extra: tuple[str, ...] = ()) -> DataFrame:
    """Stored rows at the latest time within the day before ``start``.
    Only that day's month is read.  In a table of whole days these are the
    rows of that day; else a scalar max is joined back as a one-row frame."""
    prev = _date(start) - dt.timedelta(days=1)
    rows = in_window(in_months(stored, prev, prev), time_col, prev, start)
    if not isinstance(stored.schema[time_col].dataType, T.DateType):
        latest = rows.agg(F.max(time_col).alias("_latest"))
        rows = rows.join(F.broadcast(latest), F.col(time_col) == F.col("_latest"))
    return (rows.select(*keys, F.col(amount).alias("last_amount"), *extra))


def running_balance(daily: DataFrame, keys: list[str], opening: DataFrame | None = None,
                    delta: str = "delta_amount", out: str = "cumulative_amount",
                    start=None, carry_inactive: bool = False,
                    opening_keys: list[str] | None = None) -> DataFrame:
    """C4 + W5 + J12: cumulative daily balance = opening + running sum of
    the daily deltas (one row per key and day with movement).

    ``carry_inactive``: every key with an opening balance has a row on
    ``start`` (zero plus what moves that day), so that later expansion carries
    it from the first day on, whenever it moves next (default off)."""
    d = daily
    kind = d.schema[delta].dataType
    if opening is not None:
        ok = opening_keys or keys
        op = opening.select(*[F.col(a).alias(f"_o{i}") for i, a in enumerate(ok)], F.col("last_amount").cast(kind).alias("last_amount"))
        if carry_inactive:
            extra = op.select(F.lit(_date(start)).alias("day"), *[F.col(f"_o{i}").alias(k) for i, k in enumerate(keys)], wide.zero(kind).alias(delta))
            d = d.select("day", *keys, delta).unionByName(extra).groupBy("day", *keys).agg(wide.total(F.col(delta), kind).alias(delta))
        cond = [F.col(k) == F.col(f"_o{i}") for i, k in enumerate(keys)]
        c = cond[0]
        for x in cond[1:]:
            c = c & x
        d = d.join(op, c, "left").drop(*[f"_o{i}" for i in range(len(keys))])
        base = F.coalesce(F.col("last_amount"), wide.zero(kind))
    else:
        base = wide.zero(kind)
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if wide.is_text(kind):  # the opening balance is one more term of the sum
        out_df = d.withColumn(out, wide.plus(wide.running(F.col(delta), kind, w), base))
    else:
        out_df = d.withColumn(out, base + F.sum(delta).over(w))
    return out_df.drop("last_amount") if opening is not None else out_df


def _window(df: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    if start is None and end is None:
        return df
    if start is None:
        return df.where(F.col(ts) < ts_literal(df, ts, end))
    return in_window(df, ts, start, end)


def net_flows(transfers: DataFrame, members: DataFrame, start, end,
              token: str = "contract_address", src: str = "from", dst: str = "to",
              value: str = "value", ts: str = "evt_block_time") -> DataFrame:
    """Per (day, pool, token) the value received by member pools minus
    the value they sent.  One scan of the transfers: each transfer becomes
    (to, +v) and (from, -v), a semi join keeps member wallets, and the sum
    aggregates map-side before the shuffle.  ``start`` may be None for the full
    history."""
    t = _window(transfers, start, end, ts)
    kind = transfers.schema[value].dataType
    legs = t.select(
        F.to_date(ts).alias("day"),
        F.col(token).alias("token"),
        F.explode(F.array(
            F.struct(F.col(dst).alias("pool"), F.col(value).alias("amount")),
            F.struct(F.col(src).alias("pool"), wide.negated(F.col(value), kind).alias("amount")),
        )).alias("leg"),
    ).select("day", "token", "leg.pool", "leg.amount")
    m = members.select(F.col("pool").alias("_m")).distinct()
    kept = legs.join(m, F.col("pool") == F.col("_m"), "left_semi")
    return kept.groupBy("day", "pool", "token").agg(wide.total(F.col("amount"), kind).alias("amount"))


def vault_deltas(start, end, swaps: DataFrame | None = None, balance_changes: DataFrame | None = None,
                 managed: DataFrame | None = None, internal: DataFrame | None = None) -> DataFrame:
    """C12 summed per day: (day, pool, token, delta_amount); see
    ``vault_delta_events`` for the arms."""
    u = vault_delta_events(start, end, swaps, balance_changes, managed, internal)
    return daily_deltas(u, ["pool", "token"], "ts", "delta")


def vault_delta_events(start, end, swaps: DataFrame | None = None, balance_changes: DataFrame | None = None,
                       managed: DataFrame | None = None, internal: DataFrame | None = None) -> DataFrame:
    """All vault movements as (day, pool, token, delta_amount).

    swaps: (pool, token_in, amount_in, token_out, amount_out, ts) -- one scan,
      each swap yields +in and -out;
    balance_changes: (pool, tokens[], deltas[], ts) -- lock-step explode;
    managed: (pool, token, cash_delta, managed_delta, ts) -- cash + managed;
    internal: (token, delta, ts) -- no pool (NULL).
    Arms are unioned at event grain: (ts, pool, token, delta).  ``start`` /
    ``end`` may be None for the full history."""
    arms = []
    if swaps is not None:
        s = _window(swaps, start, end)
        arms.append(s.select("ts", "pool", F.explode(F.array(
            F.struct(F.col("token_in").alias("token"), F.col("amount_in").alias("delta")),
            F.struct(F.col("token_out").alias("token"), wide.negated(F.col("amount_out"), swaps.schema["amount_out"].dataType).alias("delta")),
        )).alias("leg")).select("ts", "pool", "leg.token", "leg.delta"))
    if balance_changes is not None:
        b = _window(balance_changes, start, end)
        arms.append(zip_explode(b, ["ts", "pool"], {"token": F.col("tokens"), "delta": F.col("deltas")}))
    if managed is not None:
        m = _window(managed, start, end)
        kind = managed.schema["cash_delta"].dataType
        both = wide.plus(F.col("cash_delta"), F.col("managed_delta")) if wide.is_text(kind) else F.col("cash_delta") + F.col("managed_delta")
        arms.append(m.select("ts", "pool", "token", both.alias("delta")))
    if internal is not None:
        i = _window(internal, start, end)
        arms.append(i.select("ts", F.lit(None).cast(arms[0].schema["pool"].dataType if arms else "string").alias("pool"),
                             "token", "delta"))
    u = arms[0]
    for a in arms[1:]:
        u = u.unionByName(a)
    return u
