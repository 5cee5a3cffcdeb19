"""Valuation: token dimension, point-in-time price, and the two-source
fallback price (daily average, else the latest sparse median)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolbook.functions.generators import _date
from poolbook.functions.scalar import scale_amount, usd_value
from poolbook.operators.quantile import exact_percentile


def midnight_prices(prices: DataFrame, start=None, end=None, token: str = "contract_address",
                    minute: str = "minute", price: str = "price") -> DataFrame:
    """Price rows stamped exactly at a day's midnight, as (token, day, price).

    The minute range reaches the Parquet scan; the midnight test is a narrow
    filter that drops 1439 of 1440 minute rows before any shuffle."""
    m = F.col(minute)
    df = prices
    if start is not None:
        df = df.where(m >= F.lit(_date(start)).cast(prices.schema[minute].dataType))
    if end is not None:
        df = df.where(m < F.lit(_date(end)).cast(prices.schema[minute].dataType))
    df = df.where(m == F.to_date(m).cast(prices.schema[minute].dataType))
    return df.select(F.col(token).alias("_p_token"), F.to_date(m).alias("_p_day"), F.col(price).alias("_p_price"))


def value_at_day_open(
    df: DataFrame,
    tokens: DataFrame,
    prices: DataFrame,
    token_col: str = "token_address",
    day_col: str = "day",
    raw_col: str = "token_amount_raw",
    start=None,
    end=None,
) -> DataFrame:
    """Add ``token_symbol``, ``token_amount`` and ``token_usd_amount``.

    Left joins keep every row: an unknown token gives NULL symbol and
    amounts, a missing midnight price gives NULL USD.  No side is hinted: the
    planner and adaptive execution choose the join from measured bytes."""
    return price_at_day_open(token_dimension(df, tokens, token_col), prices, token_col, day_col, raw_col, start, end)


def unique_tokens(tokens: DataFrame) -> DataFrame:
    """One (``_t_token``, ``token_symbol``, ``_t_decimals``) row per token, so
    that repeated dimension rows cannot fan out a join; of several rows the
    largest (symbol, decimals) is taken, a known value before a NULL."""
    return (tokens.groupBy(F.col("contract_address").alias("_t_token"))
            .agg(F.max(F.struct(F.col("symbol").alias("token_symbol"), F.col("decimals").alias("_t_decimals"))).alias("_t"))
            .select("_t_token", "_t.*"))


def token_dimension(df: DataFrame, tokens: DataFrame, token_col: str = "token_address") -> DataFrame:
    """Add ``token_symbol`` and the helper ``_t_decimals`` (left join with
    the token dimension, one row per token)."""
    return df.join(unique_tokens(tokens), F.col(token_col) == F.col("_t_token"), "left").drop("_t_token")


def price_at_day_open(df: DataFrame, prices: DataFrame, token_col: str = "token_address", day_col: str = "day",
                      raw_col: str = "token_amount_raw", start=None, end=None) -> DataFrame:
    """J7 + F4 + F5 on rows that already carry ``_t_decimals``: the price at
    the day's midnight (the lowest, should a source repeat the minute), the
    scaled amount and its USD value."""
    px = midnight_prices(prices, start, end).groupBy("_p_token", "_p_day").agg(F.min("_p_price").alias("_p_price"))
    out = (
        df.join(
            px,
            (F.col(token_col) == F.col("_p_token")) & (F.col(day_col) == F.col("_p_day")),
            "left",
        )
        .withColumn("token_amount", scale_amount(raw_col, "_t_decimals"))
        .withColumn("token_usd_amount", usd_value(raw_col, "_t_decimals", "_p_price"))
    )
    return out.drop("_t_decimals", "_p_token", "_p_day", "_p_price")


def daily_average_prices(prices: DataFrame, start, end, token: str = "contract_address",
                         minute: str = "minute", price: str = "price") -> DataFrame:
    """A4: average price per (day, token) over ``[start, end)``."""
    t = prices.schema[minute].dataType
    m = F.col(minute)
    return (
        prices.where((m >= F.lit(_date(start)).cast(t)) & (m < F.lit(_date(end)).cast(t)))
        .groupBy(F.to_date(m).alias("day"), F.col(token).alias("token"))
        .agg(F.avg(price).alias("price"))
    )


def sparse_daily_medians(hourly: DataFrame, start, end, min_samples: int = 2,
                         token: str = "contract_address", hour: str = "hour",
                         median: str = "median_price", samples: str = "sample_size",
                         hot_group: int | None = None) -> DataFrame:
    """A8 + A9: per (day, token) the exact lower median of the hourly medians,
    kept when the day's total sample size exceeds ``min_samples``.

    A source of hours has at most 24 rows a group, which the built-in aggregate takes
    whole.  For a source of finer grain ``hot_group`` names the group size from which
    on the median is selected by narrowing (``quantile.exact_percentile``)."""
    t = hourly.schema[hour].dataType
    h = F.col(hour)
    inside = hourly.where((h >= F.lit(_date(start)).cast(t)) & (h < F.lit(_date(end)).cast(t)))
    if hot_group is not None:
        keyed = inside.select(F.to_date(h).alias("day"), F.col(token).alias("token"), F.col(median).alias("price"), samples)
        enough = keyed.groupBy("day", "token").agg(F.sum(samples).alias("sample_size")).where(F.col("sample_size") > min_samples)
        medians = exact_percentile(keyed, ["day", "token"], "price", limit=hot_group)
        same = F.col("day").eqNullSafe(F.col("_day")) & F.col("token").eqNullSafe(F.col("_token"))
        return enough.join(medians.toDF("_day", "_token", "price"), same, "left").drop("_day", "_token")
    return (
        inside
        .groupBy(F.to_date(h).alias("day"), F.col(token).alias("token"))
        .agg(
            F.sum(samples).alias("sample_size"),
            F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {median})").alias("price"),
        )
        .where(F.col("sample_size") > min_samples)
    )


def price_lists(sparse: DataFrame) -> DataFrame:
    """W2 + J9 for day-grain prices: one row per token, its prices as a list by day (at
    most one a day of the window), so an as-of look-up is an equi-join on the token and
    no row is made per token and day.  For prices of any grain see ``scan.asof_join``."""
    return sparse.groupBy(F.col("token").alias("_s_token")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("day").alias("day"), F.col("price").alias("price")))).alias("_s_list"))


def latest_in(prices: Column, day: Column) -> Column:
    """The price of the latest entry of a list at or before ``day`` (NULL if none)."""
    return F.try_element_at(F.filter(prices, lambda p: p["day"] <= day), F.lit(-1))["price"]


def value_with_fallback(
    df: DataFrame,
    tokens: DataFrame,
    prices: DataFrame,
    hourly: DataFrame,
    start,
    end,
    min_samples: int = 2,
    token_col: str = "token",
    day_col: str = "day",
    amounts: dict[str, str] | None = None,
    lookback_days: int = 0,
) -> DataFrame:
    """price = daily average of ``prices`` if the token has one that day,
    else the latest sparse median at or before the day (as-of).  ``amounts``
    maps raw amount columns to (scaled name, usd name).  Sparse prices are
    read from ``start - lookback_days`` (0 = the reference's behaviour)."""
    daily = daily_average_prices(prices, start, end).select(
        F.col("token").alias("_d_token"), F.col("day").alias("_d_day"), F.col("price").alias("_d_price"))
    # lookback_days > 0 lets days early in the window use a sparse price from
    # before it (the reference starts the as-of series at the window start).
    sparse_start = _date(start) - dt.timedelta(days=lookback_days)
    sparse = sparse_daily_medians(hourly, sparse_start, end, min_samples)
    out = (
        df.join(unique_tokens(tokens), F.col(token_col) == F.col("_t_token"), "left")
        .join(daily, (F.col(token_col) == F.col("_d_token")) & (F.col(day_col) == F.col("_d_day")), "left")
        .join(price_lists(sparse), F.col(token_col) == F.col("_s_token"), "left")
        .withColumn("price", F.coalesce("_d_price", latest_in(F.col("_s_list"), F.col(day_col))))
    )
    for raw, (amount_name, usd_name) in (amounts or {}).items():
        out = out.withColumn(amount_name, scale_amount(raw, "_t_decimals")).withColumn(
            usd_name, usd_value(raw, "_t_decimals", "price"))
    return out.drop("_t_token", "_t_decimals", "_d_token", "_d_day", "_d_price", "_s_token", "_s_list")
