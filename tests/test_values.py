"""Valuation, arrays, balances: NULL paths, lock-step explode, frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from poolbook.functions.generators import zip_explode
from poolbook.functions.scalar import scale_weight
from poolbook.operators.scan import asof_join
from poolbook.operators import balance, value


def as_of_july(spark, sparse):
    """The first four days of July with the latest sparse price of token A."""
    days = spark.createDataFrame([("A", dt.date(2021, 7, d)) for d in range(1, 5)], "token string, day date")
    return asof_join(days, sparse, {"token": "token"}, "day", "day", ["price"]).where("price is not null")


def test_missing_token_price_and_decimals_keep_the_row(spark):
    rows = spark.createDataFrame(
        [(dt.date(2021, 7, 1), "A", Decimal(1000)), (dt.date(2021, 7, 1), "B", Decimal(1000)),
         (dt.date(2021, 7, 1), "C", Decimal(1000))],
        "day date, token_address string, token_amount_raw decimal(38,0)")
    tokens = spark.createDataFrame([("A", "AAA", 2), ("B", "BBB", None)], "contract_address string, symbol string, decimals int")
    prices = spark.createDataFrame(
        [("A", dt.datetime(2021, 7, 1), 2.0), ("A", dt.datetime(2021, 7, 1, 12), 9.0)],
        "contract_address string, minute timestamp_ntz, price double")
    got = {r["token_address"]: r for r in value.value_at_day_open(rows, tokens, prices).collect()}
    assert got["A"]["token_amount"] == 10.0 and got["A"]["token_usd_amount"] == 20.0  # midnight price only
    assert got["B"]["token_symbol"] == "BBB" and got["B"]["token_amount"] is None
    assert got["C"]["token_symbol"] is None and got["C"]["token_usd_amount"] is None


def test_sparse_price_needs_enough_samples_and_carries_forward(spark):
    hourly = spark.createDataFrame(
        [("A", dt.datetime(2021, 7, 1, 1), 5.0, 2), ("A", dt.datetime(2021, 7, 2, 1), 7.0, 3)],
        "contract_address string, hour timestamp_ntz, median_price double, sample_size bigint")
    med = value.sparse_daily_medians(hourly, "2021-07-01", "2021-07-05", min_samples=2)
    daily = {r["day"].day: r["price"] for r in as_of_july(spark, med).collect()}
    assert daily == {2: 7.0, 3: 7.0, 4: 7.0}


def test_unequal_and_null_arrays_explode_in_lock_step(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [1, 2]), (2, ["x"], None), (3, None, None)],
                               "id int, tokens array<string>, weights array<int>")
    got = sorted(tuple(r) for r in zip_explode(df, ["id"], {"t": F.col("tokens"), "w": F.col("weights")}).collect())
    assert got == [(1, "a", 1), (1, "b", 2), (1, "c", None), (2, "x", None)]


def test_weight_scaling_is_exact(spark):
    df = spark.createDataFrame([(Decimal(500000000000000000),)], "w decimal(20,0)")
    assert df.select(scale_weight("w")).first()[0] == 0.5


def test_large_integers_fit_38_digits(spark):
    big = Decimal("9" * 38)
    df = spark.createDataFrame([("p", "t", dt.datetime(2021, 7, 1), big)], "pool string, token string, ts timestamp_ntz, delta decimal(38,0)")
    out = balance.daily_deltas(df, ["pool", "token"], "ts", "delta").first()
    assert out["delta_amount"] == big
    too_big = spark.createDataFrame([("9" * 39,)], "s string").select(F.expr("try_cast(s as decimal(38,0))")).first()[0]
    assert too_big is None


def test_in_and_out_flow_net(spark):
    tr = spark.createDataFrame(
        [("T", 7, 1, Decimal(10), dt.datetime(2021, 7, 1, 1)), ("T", 1, 9, Decimal(4), dt.datetime(2021, 7, 1, 2))],
        "contract_address string, from long, to long, value decimal(38,0), evt_block_time timestamp_ntz")
    members = spark.createDataFrame([(1,)], "pool long")
    got = balance.net_flows(tr, members, "2021-07-01", "2021-07-02").collect()
    assert [(r["pool"], int(r["amount"])) for r in got] == [(1, 6)]


def test_equal_time_deltas_range_vs_rows(spark):
    t0 = dt.datetime(2021, 7, 1, 1)
    df = spark.createDataFrame([("p", "t", t0, 1, Decimal(5)), ("p", "t", t0, 2, Decimal(7)),
                                ("p", "t", dt.datetime(2021, 7, 2), 3, Decimal(1))],
                               "pool string, token string, ts timestamp_ntz, tie int, delta decimal(38,0)")
    rng = sorted(int(r["amount_raw"]) for r in balance.running_balance_events(df, ["pool", "token"], "ts", "delta").collect())
    rows = sorted(int(r["amount_raw"]) for r in balance.running_balance_events(df, ["pool", "token"], "ts", "delta",
                                                                                frame="rows", tie="tie").collect())
    assert rng == [12, 12, 13] and rows == [5, 12, 13]


def test_opening_plus_deltas_equals_last_running_balance(spark):
    stored = spark.createDataFrame([("p", "t", Decimal(100), dt.date(2021, 6, 30))],
                                   "pool_address string, token_address string, token_amount_raw decimal(38,0), block_time date")
    opening = balance.opening_balance(stored, "2021-07-01")
    daily = spark.createDataFrame([(dt.date(2021, 7, 1), "p", "t", Decimal(5)), (dt.date(2021, 7, 3), "p", "t", Decimal(-2))],
                                  "day date, pool string, token string, delta_amount decimal(38,0)")
    rb = balance.running_balance(daily, ["pool", "token"], opening, opening_keys=["pool_address", "token_address"])
    assert sorted(int(r["cumulative_amount"]) for r in rb.collect()) == [103, 105]


def test_amounts_beyond_38_digits_are_quarantined_not_nulled(spark):
    from poolbook.sources.ingest import split_amounts, tag_amounts

    df = spark.createDataFrame([("a", "9" * 38), ("b", "9" * 39), ("c", "1" * 78), ("d", None)], "id string, amount string")
    clean, bad = split_amounts(df, ["amount"])
    assert sorted(r["id"] for r in clean.collect()) == ["a", "d"]
    got = {r["id"]: (r["amount"], r["amount_raw_text"]) for r in bad.collect()}
    assert got == {"b": (None, "9" * 39), "c": (None, "1" * 78)}
    assert tag_amounts(df, ["amount"]).where("quarantined").count() == 2


def test_sparse_price_lookback_reaches_before_the_window(spark):
    rows = spark.createDataFrame([(dt.date(2021, 7, 3), "A", Decimal(100))],
                                 "day date, token string, raw decimal(38,0)")
    tokens = spark.createDataFrame([("A", "AAA", 0)], "contract_address string, symbol string, decimals int")
    prices = spark.createDataFrame([], "contract_address string, minute timestamp_ntz, price double")
    hourly = spark.createDataFrame([("A", dt.datetime(2021, 7, 1, 5), 4.0, 10)],
                                   "contract_address string, hour timestamp_ntz, median_price double, sample_size bigint")
    args = (rows, tokens, prices, hourly, "2021-07-03", "2021-07-05", 2)
    kw = dict(token_col="token", amounts={"raw": ("amount", "usd")})
    assert value.value_with_fallback(*args, **kw).first()["usd"] is None
    assert value.value_with_fallback(*args, lookback_days=3, **kw).first()["usd"] == 400.0


def test_flow_job_carries_pools_without_movement_when_asked(spark):
    from poolbook.plans.jobs import build_flows_window

    flows = spark.createDataFrame([], "day date, pool string, token string, amount decimal(38,0)")
    deltas = spark.createDataFrame([(dt.date(2021, 7, 2), "q", "A", Decimal(5))],
                                   "day date, pool string, token string, amount decimal(38,0)")
    tokens = spark.createDataFrame([("A", "AAA", 0)], "contract_address string, symbol string, decimals int")
    prices = spark.createDataFrame([("A", dt.datetime(2021, 7, d), 2.0) for d in (1, 2, 3)],
                                   "contract_address string, minute timestamp_ntz, price double")
    hourly = spark.createDataFrame([], "contract_address string, hour timestamp_ntz, median_price double, sample_size bigint")
    weights = spark.createDataFrame([("p", "A", 0.5), ("q", "A", 0.5)], "pool_id string, token_address string, normalized_weight double")
    stored = spark.createDataFrame([(dt.date(2021, 7, 1), "p", "A", Decimal(100), "1")],
                                   "block_time date, pool_address string, token_address string, token_amount_raw decimal(38,0), version string")
    args = (flows, deltas, tokens, prices, hourly, weights, "2021-07-02", "2021-07-04", 2)
    dropped = {(r["pool_address"], r["block_time"].day) for r in build_flows_window(*args, stored=stored, carry_inactive=False).collect()}
    carried = {(r["pool_address"], r["block_time"].day, int(r["token_amount_raw"]))
               for r in build_flows_window(*args, stored=stored).collect()}
    assert dropped == {("q", 2), ("q", 3)}
    assert carried == {("q", 2, 5), ("q", 3, 5), ("p", 2, 100), ("p", 3, 100)}
