"""Pool names: label sets from registries and the token dimension, and
attaching a label to any frame with a pool column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.functions.scalar import address_value, concat_skip_null, replace_value

LABEL_TYPE = "lp_pool_name"
DEFAULT_AUTHOR = "poolbook"


def _symbols(tokens: DataFrame, alias: str) -> DataFrame:
    """Known symbols only (J18: unknown or NULL symbols drop the pool)."""
    return tokens.where(F.col("symbol").isNotNull()).select(
        F.col("contract_address").alias(f"_{alias}_tok"), F.col("symbol").alias(alias))


def _label_frame(df: DataFrame, address: str, label, author: str) -> DataFrame:
    return df.select(F.col(address).alias("address"), label.alias("label"),
                     F.lit(LABEL_TYPE).alias("type"), F.lit(author).alias("author"))


def pair_labels(registry: DataFrame, tokens: DataFrame, pool: str, token0: str, token1: str,
                prefix: str, author: str = DEFAULT_AUTHOR) -> DataFrame:
    """Q13-Q15: ``<prefix><symbol0> - <symbol1>`` for pools whose two tokens
    both have a symbol.  Two lookups from the registry into the token
    dimension replace the reference's self-join of two half-results."""
    s0, s1 = _symbols(tokens, "s0"), _symbols(tokens, "s1")
    named = (registry.join(s0, F.col(token0) == F.col("_s0_tok"))
             .join(s1, F.col(token1) == F.col("_s1_tok")))
    return _label_frame(named, pool, concat_skip_null(F.lit(prefix), F.col("s0"), F.lit(" - "), F.col("s1")), author)


def single_labels(registry: DataFrame, tokens: DataFrame, pool: str, token: str, prefix: str,
                  counter_symbol: str, author: str = DEFAULT_AUTHOR) -> DataFrame:
    """Q13 (single-token pools): ``<prefix><symbol> - <counter_symbol>``."""
    s0 = _symbols(tokens, "s0")
    named = registry.join(s0, F.col(token) == F.col("_s0_tok"))
    return _label_frame(named, pool, concat_skip_null(F.lit(prefix), F.col("s0"), F.lit(" - "), F.lit(counter_symbol)), author)


def hub_labels(events: DataFrame, tokens: DataFrame, pool: str, token: str, native, wrapped, hub,
               prefix: str, hub_symbol: str, author: str = DEFAULT_AUTHOR) -> DataFrame:
    """Q16: pools paired with a hub token: distinct (pool, reserve token)
    without the hub itself, native placeholder replaced by its wrapped token,
    named ``<prefix><symbol> - <hub_symbol>``."""
    dtype = events.schema[token].dataType
    native, wrapped, hub = (address_value(v, dtype) for v in (native, wrapped, hub))
    pairs = (events.where(F.col(token) != F.lit(hub))
             .select(F.col(pool).alias("_pool"), replace_value(F.col(token), F.lit(native), F.lit(wrapped)).alias("_tok"))
             .distinct())
    s0 = _symbols(tokens, "s0")
    named = pairs.join(s0, F.col("_tok") == F.col("_s0_tok"))
    return _label_frame(named, "_pool", concat_skip_null(F.lit(prefix), F.col("s0"), F.lit(" - "), F.lit(hub_symbol)), author)


def union_labels(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def attach_label(df: DataFrame, labels: DataFrame, address_col: str, out: str = "pool_name",
                 label_type: str = LABEL_TYPE) -> DataFrame:
    """Left join a label of ``label_type``; an address with several labels
    gets them sorted, distinct, joined by ', '.  Labels are collapsed per
    address before the join (a handful per address), so the join cannot fan
    out."""
    per_address = (labels.where(F.col("type") == label_type)
                   .groupBy(F.col("address").alias("_l_addr"))
                   .agg(F.array_join(F.array_sort(F.collect_set("label")), ", ").alias(out)))
    return df.join(per_address, F.col(address_col) == F.col("_l_addr"), "left").drop("_l_addr")
