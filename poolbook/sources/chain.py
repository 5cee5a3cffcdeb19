"""Adapters from the upstream chain tables to the operators' inputs.

``ChainTables`` resolves a logical table name to a DataFrame -- by default
``spark.table(<qualified name>)``, or Parquet files under a base folder
(``<base>/<schema>/<table>.parquet``).  The functions below rename the
decoded-event columns (``poolId``, ``tokenIn``, ``_reserveToken`` ...) to the
operator shapes and build one ``Sources`` record per exchange.  Nothing is
read until a job runs; Catalyst prunes the columns each job uses.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.functions.generators import _date
from poolbook.operators import balance
from poolbook.operators import labels as L
from poolbook.operators import pools
from poolbook.plans import jobs as J
from poolbook.plans.config import (
    BALANCER_V2_VAULT,
    BANCOR_HUB_SYMBOL,
    BANCOR_HUB_TOKEN,
    JOBS,
    LABEL_PREFIX,
    NATIVE_PLACEHOLDER,
    NATIVE_SYMBOL,
    WRAPPED_NATIVE,
)
from poolbook.plans.jobs import Sources
from poolbook.schemas import LABELS
from poolbook.session import checkpoint
from poolbook.streaming.state import (
    MarkedTable,
    SnapshotTable,
    extend_trade_members,
    extend_transfer_members,
    refresh_labels,
    stored_labels,
)

# Logical name -> qualified upstream table.
TABLES = {
    "token_balances": "erc20.token_balances",
    "tokens": "erc20.tokens",
    "prices_usd": "prices.usd",
    "transfers": "erc20.ERC20_evt_Transfer",
    "uniswap_v1_exchanges": "uniswap.Factory_evt_NewExchange",
    "uniswap_v2_pairs": "uniswap_v2.Factory_evt_PairCreated",
    "uniswap_v3_pools": "uniswap_v3.Factory_evt_PoolCreated",
    "sushi_pairs": "sushi.Factory_evt_PairCreated",
    "sushi_swaps": "sushi.Pair_evt_Swap",
    "mooniswap_pools": "mooniswap.MooniFactory_evt_Deployed",
    "mooniswap_swaps": "mooniswap.MooniSwap_evt_Swapped",
    "oneinch_pools": "onelp.MooniswapFactory_evt_Deployed",
    "oneinch_pools_v2": "onelp.MooniswapFactory_v2_evt_Deployed",
    "bancor_liquidity_added": "bancor.StandardPoolConverter_evt_LiquidityAdded",
    "curve_trades": "curvefi.view_trades",
    "balancer_v1_pools": "balancer.BFactory_evt_LOG_NEW_POOL",
    "balancer_v2_registered": "balancer_v2.Vault_evt_PoolRegistered",
    "balancer_v2_weighted_create": "balancer_v2.WeightedPoolFactory_call_create",
    "balancer_v2_weighted2_create": "balancer_v2.WeightedPool2TokensFactory_call_create",
    "balancer_v2_stable_create": "balancer_v2.StablePoolFactory_call_create",
    "balancer_v2_balance_changed": "balancer_v2.Vault_evt_PoolBalanceChanged",
    "balancer_v2_swaps": "balancer_v2.Vault_evt_Swap",
    "balancer_v2_managed": "balancer_v2.Vault_evt_PoolBalanceManaged",
    "balancer_v2_internal": "balancer_v2.Vault_evt_InternalBalanceChanged",
    "dex_token_prices": "dex.view_token_prices",
    "balancer_pool_weights": "balancer.view_pools_tokens_weights",
    "labels": "labels.labels",
}


# (project, version) -> registry that names its pools, its pool and token columns.
LABEL_REGISTRIES = {
    ("Uniswap", "1"): ("uniswap_v1_exchanges", "exchange", ("token",)),
    ("Uniswap", "2"): ("uniswap_v2_pairs", "pair", ("token0", "token1")),
    ("Uniswap", "3"): ("uniswap_v3_pools", "pool", ("token0", "token1")),
    ("Sushiswap", "1"): ("sushi_pairs", "pair", ("token0", "token1")),
    ("1inch", "1"): ("oneinch_pools", "mooniswap", ("token1", "token2")),  # first factory only, as the reference
    ("Mooniswap", "1"): ("mooniswap_pools", "mooniswap", ("token1", "token2")),
    ("Bancor", "2"): ("bancor_liquidity_added", "contract_address", ("_reserveToken",)),
}


class ChainTables:
    """Resolve logical names to DataFrames (``spark.table`` or Parquet)."""

    def __init__(self, spark: SparkSession, base: str | None = None,
                 resolve: Callable[[str], DataFrame] | None = None):
        self.spark = spark
        self.base = base
        self._resolve = resolve

    def __call__(self, name: str) -> DataFrame:
        qualified = TABLES[name]
        if self._resolve is not None:
            return self._resolve(qualified)
        if self.base is not None:
            schema, table = qualified.split(".", 1)
            return self.spark.read.parquet(os.path.join(self.base, schema, f"{table}.parquet"))
        return self.spark.table(qualified)


# ---- registries (S5-S15) ---------------------------------------------------
def pair_registry(t: ChainTables, name: str, pool_col: str = "pair") -> DataFrame:
    return t(name).select(F.col("token0"), F.col("token1"), F.col(pool_col).alias("pair"))


def oneinch_registry(t: ChainTables) -> DataFrame:
    cols = ["token1", "token2", "mooniswap"]
    return t("oneinch_pools").select(*cols).unionByName(t("oneinch_pools_v2").select(*cols))


def bancor_members(t: ChainTables) -> DataFrame:
    """(pool, token, token_index) from liquidity-added events."""
    ev = t("bancor_liquidity_added").select("contract_address", F.col("_reserveToken").alias("reserve"))
    return pools.substitute_token(ev, "contract_address", "reserve", NATIVE_PLACEHOLDER, WRAPPED_NATIVE,
                                  BANCOR_HUB_TOKEN)


def curve_members(t: ChainTables) -> DataFrame:
    return pools.pair_union_distinct(t("curve_trades"), "exchange_contract_address", "token_a_address",
                                     "token_b_address")


def balancer_v1_members(t: ChainTables) -> DataFrame:
    """C10 over all transfers (not windowed, as in the reference)."""
    return pools.tokens_seen(t("transfers"), t("balancer_v1_pools").select(F.col("pool")))


def balancer_v2_pools(t: ChainTables) -> DataFrame:
    """C11: (pool_id, pool_address, token_address, normalized_weight,
    pool_name_symbolic, pool_type) from registrations and factory calls."""
    reg = t("balancer_v2_registered").select(F.col("poolId").alias("pool_id"), F.col("evt_tx_hash").alias("tx"))

    def calls(name: str, weighted: bool) -> DataFrame:
        cols = [F.col("call_tx_hash").alias("tx"), "tokens", "symbol"]
        if weighted:
            cols.append("weights")
        return t(name).select(*cols)

    return pools.weighted_pools(reg, [
        (calls("balancer_v2_weighted_create", True), "WP"),
        (calls("balancer_v2_weighted2_create", True), "WP2T"),
        (calls("balancer_v2_stable_create", False), "SP"),
    ])


# ---- amounts that are summed (S4, S18-S21) -------------------------------------
def _amount(column: str) -> Column:
    """A signed 256-bit amount as text: sums of it are exact and never overflow."""
    return F.col(column).cast("string")


def transfers(t: ChainTables) -> DataFrame:
    return t("transfers").select("contract_address", "from", "to", _amount("value").alias("value"), "evt_block_time")


# ---- vault movements (S18-S21) ---------------------------------------------
def vault_arms(t: ChainTables, names=("swaps", "balance_changes", "managed", "internal")) -> dict[str, DataFrame]:
    """The C12 arms in operator shape (see ``balance.vault_deltas``); only
    the requested ones are read."""
    build = {
        "swaps": lambda: t("balancer_v2_swaps").select(
            F.col("poolId").alias("pool"), F.col("tokenIn").alias("token_in"), _amount("amountIn").alias("amount_in"),
            F.col("tokenOut").alias("token_out"), _amount("amountOut").alias("amount_out"),
            F.col("evt_block_time").alias("ts")),
        "balance_changes": lambda: t("balancer_v2_balance_changed").select(
            F.col("poolId").alias("pool"), "tokens", F.col("deltas").cast("array<string>").alias("deltas"), F.col("evt_block_time").alias("ts")),
        "managed": lambda: t("balancer_v2_managed").select(
            F.col("poolId").alias("pool"), "token", _amount("cashDelta").alias("cash_delta"),
            _amount("managedDelta").alias("managed_delta"), F.col("evt_block_time").alias("ts")),
        "internal": lambda: t("balancer_v2_internal").select("token", _amount("delta").alias("delta"), F.col("evt_block_time").alias("ts")),
    }
    return {n: build[n]() for n in names}


# ---- label sets (Q13-Q16) --------------------------------------------------
def label_sets(t: ChainTables, join: str | None = None) -> dict[tuple[str, str], Callable[[], DataFrame]]:
    """The pool-name label set of each (project, version) that has one.
    ``join``: join hint for the lookups into the token dimension; the planner's choice without."""
    def known() -> DataFrame:
        return t("tokens") if join is None else t("tokens").hint(join)

    def pair(table: str, pool: str, token0: str, token1: str, key: tuple[str, str]):
        return lambda: L.pair_labels(t(table), known(), pool, token0, token1, LABEL_PREFIX[key])

    def bancor() -> DataFrame:
        events = t("bancor_liquidity_added").select("contract_address", F.col("_reserveToken").alias("reserve"))
        return L.hub_labels(events, known(), "contract_address", "reserve", NATIVE_PLACEHOLDER, WRAPPED_NATIVE,
                            BANCOR_HUB_TOKEN, LABEL_PREFIX[("Bancor", "2")], BANCOR_HUB_SYMBOL)

    sets = {
        ("Uniswap", "1"): lambda: L.single_labels(t("uniswap_v1_exchanges"), known(), "exchange", "token",
                                                  LABEL_PREFIX[("Uniswap", "1")], NATIVE_SYMBOL),
        ("Bancor", "2"): bancor,
    }
    for key, (table, pool, tokens) in LABEL_REGISTRIES.items():
        if key not in sets:
            sets[key] = pair(table, pool, *tokens, key)
    return sets


def pool_labels(t: ChainTables) -> DataFrame:
    """All pool-name label sets of the reference, unioned (K3).

    The token dimension grows with the registries, so at every size it is shuffled
    once, for all lookups, and hashed by partition: it never passes whole through the
    driver, and no registry is sorted (a sort spills where one token has most pools)."""
    return L.union_labels(*[build() for build in label_sets(t, join="shuffle_hash").values()])


# ---- one Sources record per exchange (Q1-Q9, Q17) --------------------------
def _registry(t: ChainTables, job: str) -> Callable[[], DataFrame]:
    return {
        "uniswap_v1": lambda: t("uniswap_v1_exchanges").select("token", "exchange"),
        "uniswap_v2": lambda: pair_registry(t, "uniswap_v2_pairs"),
        "uniswap_v3": lambda: pair_registry(t, "uniswap_v3_pools", "pool").withColumnRenamed("pair", "pool"),
        "sushiswap_v1": lambda: pair_registry(t, "sushi_pairs"),
        "sushiswap_v1_active": lambda: pair_registry(t, "sushi_pairs"),
        "mooniswap_v1": lambda: t("mooniswap_pools").select("token1", "token2", "mooniswap"),
        "mooniswap_v1_active": lambda: t("mooniswap_pools").select("token1", "token2", "mooniswap"),
        "1inch_v1": lambda: oneinch_registry(t),
        "bancor_v2": lambda: bancor_members(t),
        "curve_v1": lambda: curve_members(t),
        "balancer_v1": lambda: balancer_v1_members(t),
    }[job]


def _trades(t: ChainTables, job: str) -> Callable[[], DataFrame] | None:
    if job == "sushiswap_v1_active":
        return lambda: t("sushi_swaps").select("contract_address", "evt_block_time")
    if job == "mooniswap_v1_active":
        return lambda: t("mooniswap_swaps").select("contract_address", "evt_block_time")
    return None


def sources_for(t: ChainTables, job: str, with_labels: bool = True, members: MarkedTable | None = None,
                names: SnapshotTable | None = None) -> Sources:
    """Inputs of ``build_window(JOBS[job], ...)`` over the chain tables; membership
    and names are read from ``members`` and ``names`` where they are kept as state."""
    if job not in JOBS:
        raise KeyError(job)
    # A pool is registered with one exchange, so its name is in that one's set.
    labels = label_sets(t).get((JOBS[job].project, JOBS[job].version)) if with_labels else None
    if names is not None:
        labels = lambda: stored_labels(t.spark, names)
    return Sources(
        balances=lambda: _balances(t),
        registry=_registry(t, job) if members is None else lambda: members.rows(t.spark),
        tokens=lambda: t("tokens").select("contract_address", "symbol", "decimals"),
        prices=lambda: t("prices_usd").select("contract_address", "minute", "price"),
        labels=labels,
        trades=_trades(t, job),
        tie="tie",
    )


def _balances(t: ChainTables) -> DataFrame:
    """The change log with a ``tie`` column: the table names no order within a
    block time, so a hash of the amount fixes one and a retried window stores
    the same value."""
    return t("token_balances").select("wallet_address", "token_address", "amount_raw", "timestamp",
                                      F.xxhash64("amount_raw").alias("tie"))


# ---- Balancer v2 and the flow design (Q10-Q12) ------------------------------
#: Version tag of the vault totals: a scope of their own beside the pools' rows.
VAULT_VERSION = "2-vault"


def _has_day_before(stored: DataFrame, start) -> bool:
    day = F.date_sub(F.lit(_date(start)), 1)
    return bool(stored.where(F.col("day") == day).limit(1).count())


def balancer_v2_window(t: ChainTables, start, end, stored: DataFrame | None = None) -> DataFrame:
    """Q10: per-pool balances from vault deltas (joins/exits, swaps, managed
    cash), keyed by the 20-byte pool address; weights as share.  With a
    stored table the balance restarts from its rows of the day before
    ``start`` (opening balance) if it has any; else it sums the full history."""
    arms = vault_arms(t, ("swaps", "balance_changes", "managed"))
    opening = None
    lo = None
    if stored is not None:
        mine = stored.where((F.col("project") == "Balancer") & (F.col("version") == "2"))
        if _has_day_before(mine, start):
            opening = balance.opening_balance(mine, start, time_col="day")
            lo = start
    events = balance.vault_delta_events(lo, end, swaps=arms["swaps"], balance_changes=arms["balance_changes"],
                                        managed=arms["managed"])
    return J.build_deltas_window(
        events, balancer_v2_pools(t), t("tokens"), t("prices_usd"), start, end,
        opening=opening, pool_prefix_len=20)


def balancer_v2_vault_window(t: ChainTables, start, end, stored: DataFrame | None = None) -> DataFrame:
    """Q11: the vault wallet's balance of every token of a registered pool."""
    src = Sources(balances=lambda: _balances(t), registry=lambda: None, tokens=lambda: t("tokens"),
                  prices=lambda: t("prices_usd"), tie="tie")
    return J.build_vault_totals_window(src, BALANCER_V2_VAULT, balancer_v2_pools(t), start, end, version=VAULT_VERSION, stored=stored)


def flow_state_table(path: str) -> SnapshotTable:
    """Closing balances of the flow design, one snapshot per window end."""
    raw = T.StringType()
    return SnapshotTable(path, T.StructType([
        T.StructField("version", T.StringType()), T.StructField("pool", T.BinaryType()), T.StructField("token", T.BinaryType()),
        T.StructField("last_delta", raw), T.StructField("last_amount", raw)]))


def balancer_flows_window(t: ChainTables, start, end, stored: DataFrame | None = None,
                          min_samples: int = 2, state: SnapshotTable | None = None) -> DataFrame:
    """Q12: flow-based balances of v1 pools (transfers) and v2 pools (vault
    deltas incl. internal balances), valued by daily average price else the
    as-of sparse median, kept where value and pool weight are positive.

    ``state``: balances restart from the latest snapshot that closed before ``start``,
    whatever their value was that day, and movements are read from the day after it
    (from the beginning, if there is none); the closing balances are stored in turn.
    Without ``state`` the opening is the stored fact rows of the day before (C13)."""
    opened = state.latest(t.spark, before=start) if state is not None else None
    since = opened[0] + dt.timedelta(days=1) if opened else None if state is not None else start
    v1 = balance.net_flows(transfers(t), t("balancer_v1_pools").select("pool"), since, end)
    v2 = balance.vault_deltas(since, end, **vault_arms(t)).withColumnRenamed("delta_amount", "amount")
    rest = (t("tokens"), t("prices_usd"), t("dex_token_prices"), t("balancer_pool_weights"), start, end, min_samples)
    if state is None:
        return J.build_flows_window(v1, v2, *rest, stored=stored)
    states = checkpoint(J.flow_states(v1, v2, end, opened and opened[1], opened and opened[0]))
    state.write(J.closing_flow_states(states, end), _date(end) - dt.timedelta(days=1))
    return J.value_flows(states, *rest)


# ---- state kept between runs (C10, U3, K3) -----------------------------------
MEMBER = T.StructType([T.StructField("pool", T.BinaryType()), T.StructField("token", T.BinaryType())])
#: Time columns of the sources that state is extended from.
TRADE_TIME, EVENT_TIME = "block_time", "evt_block_time"


def extend_members(t: ChainTables, job: str, folder: str, end) -> MarkedTable:
    """Bring the stored membership of a job up to ``end`` and return it."""
    members = MarkedTable(f"{folder.rstrip('/')}/members-{job}", MEMBER)
    if job == "curve_v1":
        extend_trade_members(t.spark, members, t("curve_trades"), end, "exchange_contract_address", "token_a_address",
                             "token_b_address", TRADE_TIME)
    elif job == "balancer_v1":
        known = MarkedTable(f"{folder.rstrip('/')}/pools-{job}", T.StructType(MEMBER.fields[:1]))
        registry = t("balancer_v1_pools")
        registered = EVENT_TIME if EVENT_TIME in registry.columns else None
        extend_transfer_members(t.spark, members, known, t("transfers"), registry, end, registered=registered)
    else:
        raise KeyError(job)
    return members


def refresh_label_slice(t: ChainTables, job: str, folder: str, end) -> SnapshotTable:
    """Bring the label slice of a job's (project, version) up to ``end``: registry rows
    after its mark are read, all its pools are named from the token dimension of today."""
    key = (JOBS[job].project, JOBS[job].version)
    table, pool, tokens = LABEL_REGISTRIES[key]
    columns = ["pool", "token_a", "token_b"][: 1 + len(tokens)]
    registry = t(table).select(*[F.col(c).alias(name) for c, name in zip((pool, *tokens), columns)], EVENT_TIME)

    def name_pools(rows: DataFrame) -> DataFrame:
        if key == ("Bancor", "2"):
            return L.hub_labels(rows, t("tokens"), "pool", "token_a", NATIVE_PLACEHOLDER, WRAPPED_NATIVE, BANCOR_HUB_TOKEN,
                                LABEL_PREFIX[key], BANCOR_HUB_SYMBOL)
        if not tokens[1:]:
            return L.single_labels(rows, t("tokens"), "pool", "token_a", LABEL_PREFIX[key], NATIVE_SYMBOL)
        return L.pair_labels(rows, t("tokens"), "pool", "token_a", "token_b", LABEL_PREFIX[key])

    at = f"{folder.rstrip('/')}/labels/project={key[0]}/version={key[1]}"
    known = MarkedTable(f"{at}/registry", T.StructType([T.StructField(c, T.BinaryType()) for c in columns]))
    names = SnapshotTable(f"{at}/names", LABELS)
    refresh_labels(t.spark, known, names, registry, name_pools, end, EVENT_TIME)
    return names
