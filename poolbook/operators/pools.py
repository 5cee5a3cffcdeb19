"""Pool registries: token position, membership, weights, activity filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.functions.generators import _date, zip_explode
from poolbook.functions.scalar import address_value, byte_prefix, replace_value, scale_weight


def unpivot_registry(registry: DataFrame, pool: str, token_cols: list[tuple[str, str]]) -> DataFrame:
    """(pool, token0, token1, ...) -> one (pool, token, token_index) row per
    listed token column.  When a token sits in several positions of a pool
    the first listed one wins (a CASE over the columns picks the first match);
    duplicate registry rows collapse."""
    arms = [
        registry.select(F.col(pool).alias("pool"), F.col(col).alias("token"), F.lit(pos).alias("_pos"))
        for pos, (col, _label) in enumerate(token_cols)
    ]
    rows = arms[0]
    for arm in arms[1:]:
        rows = rows.unionByName(arm)
    # min over an int position stays a hash aggregate; the label is looked up after.
    labels = F.array(*[F.lit(label) for _col, label in token_cols])
    first = rows.groupBy("pool", "token").agg(F.min("_pos").alias("_pos"))
    return (first.where(F.col("pool").isNotNull() & F.col("token").isNotNull())
            .select("pool", "token", F.element_at(labels, F.col("_pos") + 1).alias("token_index")))


def classify_index(
    balances: DataFrame,
    pool_tokens: DataFrame,
    wallet: str = "wallet_address",
    token: str = "token_address",
) -> DataFrame:
    """Keep balance changes of registered (pool, token) pairs and
    attach the token's position.  The reference's ``pool = wallet AND (token =
    token0 OR token = token1)`` join becomes an equi-join on the unpivoted
    registry (no nested loop)."""
    reg = pool_tokens.select(
        F.col("pool").alias("_r_pool"), F.col("token").alias("_r_token"), "token_index")
    cond = (F.col(wallet) == F.col("_r_pool")) & (F.col(token) == F.col("_r_token"))
    return balances.join(reg, cond, "inner").drop("_r_pool", "_r_token")


def constant_index(balances: DataFrame, members: DataFrame, label: str,
                   wallet: str = "wallet_address", token: str = "token_address") -> DataFrame:
    """Two-key inner join with a (pool, token) membership table and a
    constant token index; the membership is de-duplicated first."""
    reg = members.select(F.col("pool").alias("_r_pool"), F.col("token").alias("_r_token")).distinct()
    cond = (F.col(wallet) == F.col("_r_pool")) & (F.col(token) == F.col("_r_token"))
    return (balances.join(reg, cond, "inner")
            .drop("_r_pool", "_r_token").withColumn("token_index", F.lit(label)))


def exclude_pools(df: DataFrame, pools: list, wallet: str = "wallet_address") -> DataFrame:
    """Drop a constant list of pools (``NOT IN``; a NULL wallet is dropped
    too, as in SQL)."""
    if not pools:
        return df.where(F.col(wallet).isNotNull())
    dtype = df.schema[wallet].dataType
    return df.where(~F.col(wallet).isin([address_value(p, dtype) for p in pools]))


def pair_union_distinct(trades: DataFrame, pool: str, token_a: str, token_b: str) -> DataFrame:
    """``SELECT pool, a UNION SELECT pool, b`` with one scan: explode the
    pair and de-duplicate (partial aggregation map-side)."""
    return trades.select(
        F.col(pool).alias("pool"), F.explode(F.array(F.col(token_a), F.col(token_b))).alias("token")
    ).distinct()


def tokens_seen(transfers: DataFrame, pools: DataFrame, to: str = "to", token: str = "contract_address") -> DataFrame:
    """Distinct (pool, token) of transfers received by a registered pool."""
    p = pools.select(F.col("pool").alias("_pool")).distinct()
    return (
        transfers.join(p, F.col(to) == F.col("_pool"), "inner")
        .select(F.col("_pool").alias("pool"), F.col(token).alias("token"))
        .distinct()
    )


def substitute_token(events: DataFrame, pool: str, token: str, native, wrapped, hub,
                     hub_index: str = "token_1", other_index: str = "token_0") -> DataFrame:
    """P9 + P10 + A11: distinct (pool, token) with the native-coin placeholder
    replaced by its wrapped token, and the hub token placed second."""
    dtype = events.schema[token].dataType
    native, wrapped, hub = (address_value(v, dtype) for v in (native, wrapped, hub))
    sub = replace_value(F.col(token), F.lit(native), F.lit(wrapped))
    pairs = events.select(F.col(pool).alias("pool"), sub.alias("token")).distinct()
    return pairs.withColumn(
        "token_index", F.when(F.col("token") == F.lit(hub), hub_index).otherwise(other_index))


def weighted_pools(registered: DataFrame, creations: list[tuple[DataFrame, str]],
                   prefix_len: int = 20, one: int = 10**18) -> DataFrame:
    """C11: pool definitions from factory calls.

    ``registered``: (pool_id, tx).  Each creation frame: (tx, tokens[],
    weights[] or NULL, symbol) with a pool-type tag.  Registration and call
    meet on the transaction; tokens and weights explode in lock-step
    (weights / 1e18; a pool without weights gets 0); the pool address is the
    id's prefix."""
    out = None
    for calls, pool_type in creations:
        joined = registered.join(calls, "tx", "inner")
        if "weights" not in calls.columns:
            joined = joined.withColumn("weights", F.lit(None).cast("array<decimal(20,0)>"))
        rows = zip_explode(joined, ["pool_id", "symbol"], {"token_address": F.col("tokens"), "_w": F.col("weights")})
        weight = scale_weight("_w", one)
        if "weights" not in calls.columns:
            weight = F.lit(0.0)
        rows = rows.select(
            "pool_id",
            byte_prefix("pool_id", prefix_len).alias("pool_address"),
            "token_address",
            weight.alias("normalized_weight"),
            F.col("symbol").alias("pool_name_symbolic"),
            F.lit(pool_type).alias("pool_type"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def active_only(df: DataFrame, trades: DataFrame, as_of, within_days: int = 7,
                wallet: str = "wallet_address", trade_pool: str = "contract_address",
                trade_time: str = "evt_block_time") -> DataFrame:
    """Rows of pools that traded after ``as_of - within_days``
    (strictly later, as the reference's ``> now() - interval``).  A left semi
    join; the recent-trade side is reduced to distinct pools first."""
    t = trades.schema[trade_time].dataType
    cutoff = F.lit(_date(as_of)).cast(t) - F.expr(f"INTERVAL {within_days} DAYS")
    recent = trades.where(F.col(trade_time) > cutoff).select(F.col(trade_pool).alias("_active")).distinct()
    return df.join(recent, F.col(wallet) == F.col("_active"), "left_semi")


def member_tokens_only(df: DataFrame, wallet_value, pools: DataFrame,
                       wallet: str = "wallet_address", token: str = "token_address",
                       pool_token: str = "token_address") -> DataFrame:
    """P5 + J14: one wallet's rows whose token belongs to some pool."""
    member = pools.select(F.col(pool_token).alias("_tok")).distinct()
    wallet_value = address_value(wallet_value, df.schema[wallet].dataType)
    return df.where(F.col(wallet) == F.lit(wallet_value)).join(member, F.col(token) == F.col("_tok"), "left_semi")
