"""Window builds of the daily liquidity fact.

``build_window`` is the E1 plan of every registry-based exchange:

  change log  --join-->            registered (pool, token, index)
              --union-->           seed rows from the stored table
              --forward fill-->    one row per (pool, token, index, day)
              --left joins-->      token symbol/decimals, midnight price, pool name
              --project-->         the 13 columns of the fact table

Shuffles: the daily compaction (partial aggregation first), the interval
window (on compacted rows), and the joins whose smaller side is not
measured small enough to broadcast.  Building a window runs no Spark job.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolbook.functions import wide
from poolbook.functions.scalar import byte_prefix
from poolbook.operators import balance, fill, labels as L, pools, value
from poolbook.plans.config import LABEL_PREFIX, SEED_LOOKBACK_DAYS, PoolJob

LIQUIDITY_COLUMNS = [
    "day", "token_symbol", "token_amount", "pool_name", "project", "version", "category",
    "token_amount_raw", "token_usd_amount", "token_address", "pool_address", "token_index",
    "token_pool_percentage",
]


@dataclass
class Sources:
    """The inputs of a window build, as DataFrame factories.

    balances: (wallet_address, token_address, amount_raw, timestamp[, tie])
    registry: exchange-specific; pool_tokens() turns it into (pool, token, token_index)
    tokens:   (contract_address, symbol, decimals)
    prices:   (contract_address, minute, price)
    labels:   (address, label, type, author) or None
    trades:   (contract_address, evt_block_time) for activity filters, or None
    """

    balances: Callable[[], DataFrame]
    registry: Callable[[], DataFrame]
    tokens: Callable[[], DataFrame]
    prices: Callable[[], DataFrame]
    labels: Callable[[], DataFrame] | None = None
    trades: Callable[[], DataFrame] | None = None
    tie: str | None = None


def pool_tokens(job: PoolJob, registry: DataFrame) -> DataFrame:
    """(pool, token, token_index) of the job's registry."""
    if job.registry_kind == "pair":
        return pools.unpivot_registry(registry, job.pool_col, list(job.index))
    if job.registry_kind == "single":
        return pools.unpivot_registry(registry, job.pool_col, [("token", job.constant_index)])
    if job.registry_kind == "membership":
        has_index = "token_index" in registry.columns
        idx = F.col("token_index") if has_index else F.lit(job.constant_index)
        return registry.select("pool", "token", idx.alias("token_index")).distinct()
    raise ValueError(f"unknown registry kind {job.registry_kind!r}")


def build_window(job: PoolJob, src: Sources, start, end, stored: DataFrame | None = None,
                 seed_mode: str = "lookback", lookback_days: int = SEED_LOOKBACK_DAYS,
                 as_of=None) -> DataFrame:
    """Rows of the fact table for days in ``[start, end)`` (not yet written)."""
    changes = src.balances()
    if job.active_within_days is not None and stored is None:
        # The active drafts read all history, so that a pool's state from
        # before the window is carried into it.
        changes = changes.where(F.col("timestamp") < fill.ts_literal(changes, "timestamp", end))
    else:
        changes = fill.in_window(changes, "timestamp", start, end)
    if job.active_within_days is not None:
        changes = pools.active_only(changes, src.trades(), as_of or end, job.active_within_days)
    classified = pools.classify_index(changes, pool_tokens(job, src.registry()))
    cols = ["wallet_address", "token_address", "amount_raw", "timestamp", "token_index"]
    if src.tie:
        cols.append(src.tie)
    log = classified.select(*cols)
    rank = None
    if stored is not None:
        mine = stored.where((F.col("project") == job.project) & (F.col("version") == job.version))
        seeds = fill.seed_rows(mine, start, lookback_days, mode=seed_mode).select(
            F.col("pool_address").alias("wallet_address"), "token_address",
            F.col("token_amount_raw").alias("amount_raw"), "day", "token_index")
        log = fill.seeded_changes(log, seeds, "timestamp", "amount_raw")
        rank = "_src_rank"
    if job.exclude:  # after the union: stored rows of an excluded pool are dropped too
        log = pools.exclude_pools(log, list(job.exclude))
    intervals = fill.daily_intervals(
        log, ["wallet_address", "token_address", "token_index"], "amount_raw", "timestamp",
        end, rank=rank, tie=src.tie)
    states = intervals.select(
        "day", "next_day",
        F.col("wallet_address").alias("pool_address"),
        "token_address",
        "token_index",
        F.col("amount_raw").alias("token_amount_raw"),
    )
    # Day-independent lookups run on the interval rows, before the expansion.
    states = value.token_dimension(states, src.tokens())
    if src.labels is not None:
        states = L.attach_label(states, src.labels(), "pool_address")
    else:
        states = states.withColumn("pool_name", F.lit(None).cast("string"))
    rows = fill.expand_days(states, start, end)
    valued = value.price_at_day_open(rows, src.prices(), start=start, end=end)
    share = F.lit(job.share).cast("double") if job.share is not None else F.lit(None).cast("double")
    out = (valued.withColumn("project", F.lit(job.project))
           .withColumn("version", F.lit(job.version))
           .withColumn("category", F.lit(job.category))
           .withColumn("token_pool_percentage", share))
    return quarantined(out.select(*LIQUIDITY_COLUMNS), ["token_amount_raw"])


def vault_totals_changes(balances: DataFrame, vault, pool_defs: DataFrame) -> DataFrame:
    """Q11 change log: balances of the one vault wallet, restricted to tokens
    that belong to some registered pool (semi join), index ``token_x``."""
    member = pools.member_tokens_only(balances, vault, pool_defs.select("token_address"))
    return member.withColumn("token_index", F.lit("token_x"))


def build_vault_totals_window(src: Sources, vault, pool_defs: DataFrame, start, end,
                              project: str = "Balancer", version: str = "2",
                              stored: DataFrame | None = None) -> DataFrame:
    """Q11: daily vault totals per token (pool share unknown: NULL)."""
    changes = fill.in_window(src.balances(), "timestamp", start, end)
    log = vault_totals_changes(changes, vault, pool_defs).select(
        "wallet_address", "token_address", "amount_raw", "timestamp", "token_index", *([src.tie] if src.tie else []))
    rank = None
    if stored is not None:
        mine = stored.where((F.col("project") == project) & (F.col("version") == version))
        seeds = fill.seed_rows(mine, start).select(
            F.col("pool_address").alias("wallet_address"), "token_address",
            F.col("token_amount_raw").alias("amount_raw"), "day", "token_index")
        log = fill.seeded_changes(log, seeds, "timestamp", "amount_raw")
        rank = "_src_rank"
    daily = fill.forward_fill_daily(log, ["wallet_address", "token_address", "token_index"], "amount_raw",
                                    "timestamp", start, end, rank=rank, tie=src.tie)
    rows = daily.select("day", F.col("wallet_address").alias("pool_address"), "token_address", "token_index",
                        F.col("amount_raw").alias("token_amount_raw"))
    valued = value.value_at_day_open(rows, src.tokens(), src.prices(), start=start, end=end)
    out = (valued.withColumn("pool_name", F.lit(None).cast("string"))
           .withColumn("project", F.lit(project)).withColumn("version", F.lit(version))
           .withColumn("category", F.lit("DEX"))
           .withColumn("token_pool_percentage", F.lit(None).cast("double"))
           .select(*LIQUIDITY_COLUMNS))
    return quarantined(out, ["token_amount_raw"])


def build_deltas_window(deltas: DataFrame, pool_defs: DataFrame, tokens: DataFrame, prices: DataFrame,
                        start, end, labels: DataFrame | None = None, project: str = "Balancer",
                        version: str = "2", name_prefix: str = LABEL_PREFIX[("Balancer", "2")],
                        opening: DataFrame | None = None, ts: str = "ts",
                        pool_prefix_len: int | None = None) -> DataFrame:
    """Q10: per-pool balances from signed deltas.

    ``deltas``: (pool, token, delta, ts) -- the vault delta union (C12) at
    event grain.  Daily sums (partial aggregation) feed a running balance
    over days (+ optional opening balance), which is forward-filled over the
    window.  ``pool_defs`` (pool_address, token_address, normalized_weight,
    pool_name_symbolic) gives the share and the fallback pool name."""
    if pool_prefix_len:
        # Vault events name pools by a 32-byte id whose first 20 bytes are the
        # pool's address; key everything by the address so the definitions
        # (and the stored table) join on equal values.
        deltas = deltas.withColumn("pool", byte_prefix("pool", pool_prefix_len))
    upto = deltas.where(F.col(ts) < fill.ts_literal(deltas, ts, end))
    if opening is not None:
        upto = fill.in_window(upto, ts, start, end)
    daily = balance.daily_deltas(upto, ["pool", "token"], ts, "delta")
    rb = balance.running_balance(daily, ["pool", "token"], opening, start=start,
                                 opening_keys=["pool_address", "token_address"] if opening is not None else None,
                                 carry_inactive=opening is not None)
    state = rb.select("pool", "token", "day", F.col("cumulative_amount").alias("token_amount_raw"))
    intervals = fill.close_intervals(state, ["pool", "token"], end)
    # Day-independent lookups (pool definition, token, name) on the interval
    # rows; only the price needs the expanded days.
    defs = pool_defs.select(F.col("pool_address").alias("_d_pool"), F.col("token_address").alias("_d_tok"),
                            "normalized_weight", "pool_name_symbolic")
    states = (intervals.join(defs,
                             (F.col("pool") == F.col("_d_pool")) & (F.col("token") == F.col("_d_tok")), "left")
              .select("day", "next_day", F.col("pool").alias("pool_address"), F.col("token").alias("token_address"),
                      "token_amount_raw", "normalized_weight", "pool_name_symbolic"))
    states = value.token_dimension(states, tokens)
    computed = F.when(F.col("pool_name_symbolic").isNotNull(),
                      F.concat(F.lit(name_prefix), F.col("pool_name_symbolic")))
    if labels is not None:
        states = L.attach_label(states, labels, "pool_address", out="_label")
        name = F.coalesce(F.col("_label"), computed)
    else:
        name = computed
    states = states.withColumn("pool_name", name)
    rows = fill.expand_days(states, start, end)
    valued = value.price_at_day_open(rows, prices, start=start, end=end)
    out = (valued
           .withColumn("project", F.lit(project)).withColumn("version", F.lit(version))
           .withColumn("category", F.lit("DEX")).withColumn("token_index", F.lit("token_x"))
           .withColumn("token_pool_percentage", F.col("normalized_weight").cast("double"))
           .select(*LIQUIDITY_COLUMNS))
    return quarantined(out, ["token_amount_raw"])


VIEW_LIQUIDITY_COLUMNS = [
    "block_time", "pool_address", "token_address", "token_symbol", "token_weight", "delta_token_amount",
    "delta_token_amount_raw", "delta_usd_amount", "token_amount", "token_amount_raw", "usd_amount", "version",
]


FLOW_STATE = ["version", "pool", "token", "last_delta", "last_amount"]


def flow_states(flows_v1: DataFrame, deltas_v2: DataFrame, end, opening: DataFrame | None = None, opening_day=None,
                carry_inactive: bool = True) -> DataFrame:
    """Q12 balances: (day, next_day, version, pool, token, delta_amount,
    cumulative_amount), each row holding until ``next_day``.

    flows_v1 / deltas_v2: (day, pool, token, amount) daily movements of the two
    versions (C7, C12) after ``opening_day``.  ``opening`` (FLOW_STATE) is one more
    row per key on ``opening_day`` whose step is the balance itself, so every opening
    key holds its balance, version and last delta until it moves next (D10).  With
    ``carry_inactive=False`` opening rows only feed the sum, as in the reference: a key
    has no row before its first movement."""
    arms = [flows_v1.select("day", F.lit("1").alias("version"), "pool", "token", "amount"),
            deltas_v2.select("day", F.lit("2").alias("version"), "pool", "token", "amount")]
    both = arms[0].unionByName(arms[1])
    given = both.schema["amount"].dataType
    daily = both.groupBy("day", "version", "pool", "token").agg(
        wide.total(F.coalesce(F.col("amount"), wide.zero(given)), given).alias("delta_amount"))
    kind = daily.schema["delta_amount"].dataType
    steps = daily.select("day", "version", "pool", "token", "delta_amount", F.col("delta_amount").alias("_step"), F.lit(False).alias("_seed"))
    if opening is not None:
        steps = steps.unionByName(opening.select(
            F.lit(fill._date(opening_day)).alias("day"), "version", "pool", "token", F.col("last_delta").cast(kind).alias("delta_amount"),
            F.col("last_amount").cast(kind).alias("_step"), F.lit(True).alias("_seed")))
    held = Window.partitionBy("pool", "token").orderBy("day", "version")
    upto = held.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = (steps.withColumn("cumulative_amount", wide.running(F.col("_step"), kind, upto))
              .withColumn("next_day", F.lead("day", 1, fill._date(end)).over(held)))
    if not carry_inactive:
        states = states.where(~F.col("_seed"))
    return states.drop("_step", "_seed")


def closing_flow_states(states: DataFrame, end) -> DataFrame:
    """The balances at the end of the window (FLOW_STATE): the opening of the next one."""
    return states.where(F.col("next_day") == F.lit(fill._date(end))).select(
        "version", "pool", "token", F.col("delta_amount").alias("last_delta"), F.col("cumulative_amount").alias("last_amount"))


def stored_opening(stored: DataFrame, start) -> DataFrame:
    """C13 as FLOW_STATE: the fact rows of the day before ``start``.  Keys without a
    positive value that day are not in the fact table; ``flow_states`` closed by
    ``closing_flow_states`` has them."""
    delta = "delta_token_amount_raw" if "delta_token_amount_raw" in stored.columns else None
    rows = balance.opening_balance(stored, start, extra=("version", delta) if delta else ("version",))
    return rows.select("version", F.col("pool_address").alias("pool"), F.col("token_address").alias("token"),
                       (F.col(delta) if delta else F.lit(None)).alias("last_delta"), "last_amount")


def build_flows_window(flows_v1: DataFrame, deltas_v2: DataFrame, tokens: DataFrame, prices: DataFrame,
                       hourly: DataFrame, weights: DataFrame, start, end, min_samples: int = 2,
                       stored: DataFrame | None = None, carry_inactive: bool = True,
                       price_lookback_days: int = 0) -> DataFrame:
    """Q12: the flow-based design, restarted from the fact rows of the day before
    ``start`` if ``stored`` is given (see ``flow_states`` and ``value_flows``)."""
    opening = stored_opening(stored, start) if stored is not None else None
    before = fill._date(start) - dt.timedelta(days=1)
    states = flow_states(flows_v1, deltas_v2, end, opening, before, carry_inactive)
    return value_flows(states, tokens, prices, hourly, weights, start, end, min_samples, price_lookback_days)


def value_flows(states: DataFrame, tokens: DataFrame, prices: DataFrame, hourly: DataFrame, weights: DataFrame, start, end,
                min_samples: int = 2, price_lookback_days: int = 0) -> DataFrame:
    """Fact rows of ``flow_states``: each balance on each of its days (calendar left
    join, J5), valued by the daily average price, else the as-of sparse median (C6);
    only rows with a positive value and a positive pool weight are kept (J11, P11)."""
    cal = fill.calendar_left_fill(states.select("day", "next_day", "version", "pool", "token", "delta_amount",
                                                "cumulative_amount"), start, end)
    valued = value.value_with_fallback(
        cal, tokens, prices, hourly, start, end, min_samples, token_col="token", day_col="day",
        amounts={"delta_amount": ("delta_token_amount", "delta_usd_amount"),
                 "cumulative_amount": ("token_amount", "usd_amount")},
        lookback_days=price_lookback_days)
    wt = weights.select(F.col("pool_id").alias("_w_pool"), F.col("token_address").alias("_w_tok"),
                        F.col("normalized_weight").alias("token_weight"))
    kept = (valued.join(wt,
                        (F.col("pool") == F.col("_w_pool")) & (F.col("token") == F.col("_w_tok")))
            .where((F.col("usd_amount") > 0) & (F.col("token_weight") > 0)))
    out = kept.select(
        F.col("day").alias("block_time"), F.col("pool").alias("pool_address"), F.col("token").alias("token_address"),
        "token_symbol", "token_weight", "delta_token_amount",
        F.col("delta_amount").alias("delta_token_amount_raw"), "delta_usd_amount", "token_amount",
        F.col("cumulative_amount").alias("token_amount_raw"), "usd_amount", "version")
    return quarantined(out, ["token_amount_raw", "delta_token_amount_raw"])


#: Column of rows whose raw amount does not fit the fact table: its text.
AMOUNT_TEXT = "amount_text"


def quarantined(rows: DataFrame, amounts: list[str]) -> DataFrame:
    """Rows with text amounts (up to 78 digits) in the fact's DECIMAL(38,0).  Those that
    do not fit get a NULL amount and their text in ``amount_text``; the sink
    (``polling.write_window``) stores them in the quarantine table, not in the fact."""
    wide_ones = [c for c in amounts if wide.is_text(rows.schema[c].dataType)]
    if not wide_ones:
        return rows
    text = F.coalesce(*[wide.too_wide(F.col(c)) for c in wide_ones])
    return rows.withColumn(AMOUNT_TEXT, text).withColumns({c: wide.fitting(F.col(c)) for c in wide_ones})
