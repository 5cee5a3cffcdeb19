"""Target schemas, keys and physical layout of the two fact tables, plus the
schemas of the chain-shaped inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.DecimalType(38, 0)
WEIGHT = T.DecimalType(38, 18)

# Daily liquidity fact: one row per (day, pool, token).  Column order is the
# order the stored table keeps.
LIQUIDITY = T.StructType(
    [
        T.StructField("day", T.DateType(), False),
        T.StructField("token_symbol", T.StringType()),
        T.StructField("token_amount", T.DoubleType()),
        T.StructField("pool_name", T.StringType()),
        T.StructField("project", T.StringType(), False),
        T.StructField("version", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("token_amount_raw", RAW),
        T.StructField("token_usd_amount", T.DoubleType()),
        T.StructField("token_address", T.BinaryType(), False),
        T.StructField("pool_address", T.BinaryType(), False),
        T.StructField("token_index", T.StringType()),
        T.StructField("token_pool_percentage", T.DoubleType()),
    ]
)
LIQUIDITY_KEY = ["day", "pool_address", "token_address"]
# Files are partitioned so that a job reads only its own project/version and
# the months its window touches; rows inside a file are sorted by day, pool.
LIQUIDITY_PARTITIONS = ["project", "version", "month"]

# Flow-based fact (deltas, weights); token_address is nullable yet part of
# the key, and a NULL key never equals another one.
VIEW_LIQUIDITY = T.StructType(
    [
        T.StructField("block_time", T.DateType(), False),
        T.StructField("pool_address", T.BinaryType(), False),
        T.StructField("token_address", T.BinaryType()),
        T.StructField("token_symbol", T.StringType()),
        T.StructField("token_weight", T.DoubleType()),
        T.StructField("delta_token_amount", T.DoubleType()),
        T.StructField("delta_token_amount_raw", RAW),
        T.StructField("delta_usd_amount", T.DoubleType()),
        T.StructField("token_amount", T.DoubleType()),
        T.StructField("token_amount_raw", RAW),
        T.StructField("usd_amount", T.DoubleType()),
        T.StructField("version", T.StringType()),
    ]
)
VIEW_LIQUIDITY_KEY = ["block_time", "pool_address", "token_address"]

LABELS = T.StructType(
    [
        T.StructField("address", T.BinaryType()),
        T.StructField("label", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("author", T.StringType()),
    ]
)

# Inputs (column names as the operators use them).
TOKEN_BALANCES = T.StructType(
    [
        T.StructField("wallet_address", T.BinaryType()),
        T.StructField("token_address", T.BinaryType()),
        T.StructField("amount_raw", RAW),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
TOKENS = T.StructType(
    [
        T.StructField("contract_address", T.BinaryType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("decimals", T.IntegerType()),
    ]
)
PRICES_USD = T.StructType(
    [
        T.StructField("contract_address", T.BinaryType()),
        T.StructField("minute", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
    ]
)
TOKEN_PRICES_HOURLY = T.StructType(
    [
        T.StructField("contract_address", T.BinaryType()),
        T.StructField("hour", T.TimestampType()),
        T.StructField("median_price", T.DoubleType()),
        T.StructField("sample_size", T.LongType()),
    ]
)
TRANSFERS = T.StructType(
    [
        T.StructField("contract_address", T.BinaryType()),
        T.StructField("from", T.BinaryType()),
        T.StructField("to", T.BinaryType()),
        T.StructField("value", RAW),
        T.StructField("evt_block_time", T.TimestampType()),
    ]
)
PAIR_REGISTRY = T.StructType(
    [
        T.StructField("token0", T.BinaryType()),
        T.StructField("token1", T.BinaryType()),
        T.StructField("pair", T.BinaryType()),
    ]
)
