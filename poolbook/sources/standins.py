"""Chain-shaped inputs derived from the driver's test tables.

The test tables hold no chain data, so each input of the operators is
played by a projection of one of them (rules in SURVEY §7.3).  Every
stand-in reads whole tables; nothing is sampled or capped.  Addresses are
played by integers (wallets, pools) and strings (tokens).

| input            | played by                                                  |
| ---------------- | ---------------------------------------------------------- |
| token balances   | events: wallet=user_id, token=event_type, amount=value*100 |
| pair registry    | customer: pair=c_custkey, two event types by c_custkey % 3 |
| token dimension  | fixed rows: one type missing, one NULL symbol/decimals     |
| minute prices    | events: weekdays only, no 'signup'; midnight=max, noon=min |
| hourly medians   | events on Saturdays: per hour max(value), count(*)         |
| vault deltas     | orders: pool=o_custkey, token=o_orderpriority              |
| transfers        | lineitem x orders: from=l_suppkey, to=o_custkey            |
| member pools     | customer in market segment BUILDING                        |
| trades           | lineitem: pool=l_suppkey, tokens l_returnflag/l_linestatus |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.sources.tables import read_table

# Fixed values of the stand-in token dimension: (token, symbol, decimals).
# 'view' has no row; 'error' has no symbol; 'purchase' has no decimals.
STANDIN_TOKENS = [
    ("click", "CLK", 2),
    ("error", None, 2),
    ("purchase", "PUR", None),
    ("signup", "SGN", 0),
]
# Pair registry: token0/token1 chosen by c_custkey % 3.
STANDIN_PAIRS = {0: ("click", "error"), 1: ("purchase", "signup"), 2: ("view", "click")}
# Token without any minute price (valued by the sparse fallback only).
UNPRICED_TOKEN = "signup"


def balances(spark: SparkSession, base: str) -> DataFrame:
    """Change log: balance of (wallet, token) became amount_raw at timestamp."""
    ev = read_table(spark, base, "events")
    return ev.select(
        F.col("user_id").alias("wallet_address"),
        F.col("event_type").alias("token_address"),
        F.round(F.col("value") * 100).cast("decimal(38,0)").alias("amount_raw"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("tie"),
    )


def pair_registry(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey") % 3
    t0 = t1 = None
    for r, (a, b) in STANDIN_PAIRS.items():
        t0 = (F.when(k == r, a) if t0 is None else t0.when(k == r, a))
        t1 = (F.when(k == r, b) if t1 is None else t1.when(k == r, b))
    return c.select(F.col("c_custkey").alias("pair"), t0.alias("token0"), t1.alias("token1"))


def single_registry(spark: SparkSession, base: str) -> DataFrame:
    """Single-token registry (one token per pool, paired with the native coin)."""
    return pair_registry(spark, base).select(F.col("pair").alias("exchange"), F.col("token0").alias("token"))


def tokens(spark: SparkSession) -> DataFrame:
    """The fixed token dimension."""
    schema = T.StructType(
        [
            T.StructField("contract_address", T.StringType()),
            T.StructField("symbol", T.StringType()),
            T.StructField("decimals", T.IntegerType()),
        ]
    )
    return spark.createDataFrame(STANDIN_TOKENS, schema)


def _weekday(day_col):
    return F.weekday(day_col)  # 0 = Monday .. 6 = Sunday


def prices(spark: SparkSession, base: str) -> DataFrame:
    """Minute-grain price table: a midnight row (day's max) and a noon row
    (day's min) per token and weekday; no rows on weekends or for
    ``UNPRICED_TOKEN``."""
    ev = read_table(spark, base, "events")
    day = F.to_date("ts")
    per_day = (
        ev.where((_weekday(day) < 5) & (F.col("event_type") != UNPRICED_TOKEN))
        .groupBy(F.col("event_type").alias("contract_address"), day.alias("day"))
        .agg(F.max("value").alias("hi"), F.min("value").alias("lo"))
    )
    midnight = per_day.select("contract_address", F.col("day").cast("timestamp_ntz").alias("minute"), F.col("hi").alias("price"))
    noon = per_day.select(
        "contract_address",
        (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("minute"),
        F.col("lo").alias("price"),
    )
    return midnight.unionByName(noon)


def hourly(spark: SparkSession, base: str) -> DataFrame:
    """Hourly medians with sample sizes, on Saturdays only."""
    ev = read_table(spark, base, "events")
    return (
        ev.where(_weekday(F.to_date("ts")) == 5)
        .groupBy(F.col("event_type").alias("contract_address"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        .agg(F.max("value").alias("median_price"), F.count(F.lit(1)).alias("sample_size"))
    )


# Order priority -> token of the delta stand-in.
PRIORITY_TOKEN = {
    "1-URGENT": "click",
    "2-HIGH": "error",
    "3-MEDIUM": "purchase",
    "4-NOT SPECIFIED": "signup",
    "5-LOW": "view",
}


def _priority_token():
    expr = None
    for k, v in PRIORITY_TOKEN.items():
        expr = F.when(F.col("o_orderpriority") == k, v) if expr is None else expr.when(F.col("o_orderpriority") == k, v)
    return expr


def deltas(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    signed = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return o.select(
        F.col("o_custkey").alias("pool"),
        _priority_token().alias("token"),
        F.col("o_orderdate").alias("evt_block_time"),
        F.col("o_orderkey").alias("tie"),
        signed.cast("decimal(18,2)").alias("delta"),
    )


def transfers(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("contract_address"),
        F.col("l_suppkey").alias("from"),
        F.col("o_custkey").alias("to"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
        F.col("l_shipdate").alias("evt_block_time"),
    )


def members(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    return c.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("pool"))


def trades(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("exchange_contract_address"),
        F.col("l_returnflag").alias("token_a_address"),
        F.col("l_linestatus").alias("token_b_address"),
    )


def supplier_registry(spark: SparkSession, base: str) -> DataFrame:
    """Second pair registry (suppliers), same token rule as ``pair_registry``."""
    c = read_table(spark, base, "supplier")
    k = F.col("s_suppkey") % 3
    t0 = t1 = None
    for r, (a, b) in STANDIN_PAIRS.items():
        t0 = (F.when(k == r, a) if t0 is None else t0.when(k == r, a))
        t1 = (F.when(k == r, b) if t1 is None else t1.when(k == r, b))
    return c.select(F.col("s_suppkey").alias("pair"), t0.alias("token0"), t1.alias("token1"))


def swaps_activity(spark: SparkSession, base: str) -> DataFrame:
    """Swap events (pool, time): the 'purchase' events of each wallet."""
    ev = read_table(spark, base, "events")
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("contract_address"), F.col("ts").alias("evt_block_time"))


def curve_trades(spark: SparkSession, base: str) -> DataFrame:
    """Trades naming two tokens of a pool: every event is a trade of its type
    against 'click' (or 'view' for clicks)."""
    ev = read_table(spark, base, "events")
    other = F.when(F.col("event_type") == "click", "view").otherwise("click")
    return ev.select(
        F.col("user_id").alias("exchange_contract_address"),
        F.col("event_type").alias("token_a_address"),
        other.alias("token_b_address"),
        F.col("ts").alias("block_time"),
    )


def vault_swaps(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("pool"),
        F.col("l_returnflag").alias("token_in"),
        F.col("l_quantity").cast("decimal(38,2)").alias("amount_in"),
        F.col("l_linestatus").alias("token_out"),
        F.col("l_extendedprice").cast("decimal(38,2)").alias("amount_out"),
        F.col("l_shipdate").alias("ts"),
    )


def vault_balance_changes(spark: SparkSession, base: str) -> DataFrame:
    """Join/exit events with token and delta arrays; 'P' orders carry one
    delta for two tokens (the second token's delta is missing)."""
    o = read_table(spark, base, "orders")
    price = F.col("o_totalprice").cast("decimal(38,2)")
    other = -F.col("o_custkey").cast("decimal(38,2)")
    return o.select(
        F.col("o_custkey").alias("pool"),
        F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("tokens"),
        F.when(F.col("o_orderstatus") == "P", F.array(price)).otherwise(F.array(price, other)).alias("deltas"),
        F.col("o_orderdate").alias("ts"),
    )


def vault_managed(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    return o.where(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").alias("pool"),
        F.col("o_orderpriority").alias("token"),
        F.col("o_totalprice").cast("decimal(38,2)").alias("cash_delta"),
        (-F.col("o_orderkey").cast("decimal(38,2)")).alias("managed_delta"),
        F.col("o_orderdate").alias("ts"),
    )


def vault_internal(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select(
        F.col("l_linestatus").alias("token"),
        F.col("l_tax").cast("decimal(38,2)").alias("delta"),
        F.col("l_shipdate").alias("ts"),
    )


def pool_registrations(spark: SparkSession, base: str) -> DataFrame:
    """(pool_id, tx): pages registered as pools; the id is a 64-hex-digit
    hash, its first 40 digits play the 20-byte pool address."""
    p = read_table(spark, base, "pages")
    return p.select(F.sha2(F.col("url"), 256).alias("pool_id"), F.col("page_id").alias("tx"))


def pool_creations(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """Factory calls from embeddings: label 0-3 weighted (33 tokens, 31
    weights), 4-6 two-token (32 and 31), 7-9 stable (64 tokens, no weights).
    Weights are fixed-point with 1e18 = 100 %."""
    e = read_table(spark, base, "embeddings")
    n_tokens = {"WP": 33, "WP2T": 32, "SP": 64}[kind]
    cond = {"WP": F.col("label") < 4, "WP2T": (F.col("label") >= 4) & (F.col("label") < 7), "SP": F.col("label") >= 7}[kind]
    tokens = F.transform(F.slice("embedding", 1, n_tokens), lambda x: F.round(x.cast("double") * 1000).cast("bigint"))
    cols = [F.col("vec_id").alias("tx"), tokens.alias("tokens"),
            F.concat(F.lit("BPT-"), F.col("label").cast("string")).alias("symbol")]
    if kind != "SP":
        weights = F.transform(F.slice("embedding", 34, 31),
                              lambda x: (F.round(F.abs(x.cast("double")) * 100) * F.lit(1e16)).cast("decimal(20,0)"))
        cols.insert(2, weights.alias("weights"))
    return e.where(cond).select(*cols)


def event_transfers(spark: SparkSession, base: str) -> DataFrame:
    """Token transfers between wallets: each event moves value*100 of its
    type from the user to the wallet named by the event's ``k`` property."""
    ev = read_table(spark, base, "events")
    return ev.select(
        F.col("event_type").alias("contract_address"),
        F.col("user_id").alias("from"),
        F.get_json_object("props", "$.k").cast("bigint").alias("to"),
        F.round(F.col("value") * 100).cast("decimal(38,0)").alias("value"),
        F.col("ts").alias("evt_block_time"),
    )


def event_vault_swaps(spark: SparkSession, base: str) -> DataFrame:
    """Vault swaps: each 'purchase' swaps value*100 'purchase' in for
    value*40 'click' out of pool user_id."""
    ev = read_table(spark, base, "events")
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("pool"),
        F.lit("purchase").alias("token_in"),
        F.round(F.col("value") * 100).cast("decimal(38,0)").alias("amount_in"),
        F.lit("click").alias("token_out"),
        F.round(F.col("value") * 40).cast("decimal(38,0)").alias("amount_out"),
        F.col("ts").alias("ts"),
    )


def pool_weights(spark: SparkSession, base: str) -> DataFrame:
    """(pool_id, token_address, normalized_weight) from the pair registry:
    token0 weighs c_acctbal / 10000 (negative for some), token1 the rest."""
    c = read_table(spark, base, "customer")
    reg = pair_registry(spark, base).join(c.select(F.col("c_custkey").alias("pair"), "c_acctbal"), "pair")
    w0 = F.col("c_acctbal") / F.lit(10000.0)
    a = reg.select(F.col("pair").alias("pool_id"), F.col("token0").alias("token_address"), w0.alias("normalized_weight"))
    b = reg.select(F.col("pair").alias("pool_id"), F.col("token1").alias("token_address"), (F.lit(1.0) - w0).alias("normalized_weight"))
    return a.unionByName(b)
