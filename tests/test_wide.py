"""Amounts of up to 78 digits: exact sums, and jobs that keep going."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.functions import wide
from poolbook.plans.config import JOBS
from poolbook.plans.jobs import build_window
from poolbook.sources import chain
from poolbook.streaming import polling
from tests.test_state import POOLS, TOKENS, day, flow_tables, write

BIG = 2**256 - 1
TEXT = T.StringType()


def test_sums_of_256_bit_amounts_are_exact(spark):
    rnd = random.Random(4)
    pick = lambda: rnd.choice([BIG, -BIG, 0, 1, -1, 10**28, -(10**28), 10**56 - 1, -(10**56), rnd.randrange(-BIG, BIG)])
    rows = [(g, i, None if rnd.random() < 0.1 else str(pick())) for g in "ab" for i in range(300)]
    rows += [("only", 0, None), ("cancel", 0, str(BIG)), ("cancel", 1, str(-BIG))]
    df = spark.createDataFrame(rows, "g string, i int, v string").repartition(5)
    exact = {g: [int(v) for h, _, v in rows if h == g and v is not None] for g in ("a", "b", "only", "cancel")}
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(wide.total(F.col("v"), TEXT).alias("s")).collect()}
    assert got == {g: str(sum(v)) if v else None for g, v in exact.items()}
    upto = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = df.withColumn("s", wide.running(F.col("v"), TEXT, upto)).where("i = 299").collect()
    assert {r["g"]: r["s"] for r in last} == {g: got[g] for g in "ab"}
    pairs = spark.createDataFrame([(str(pick()), str(pick())) for _ in range(200)], "a string, b string")
    for r in pairs.select("a", "b", wide.plus(F.col("a"), F.col("b")).alias("s"), wide.negated(F.col("a"), TEXT).alias("n")).collect():
        assert int(r["s"]) == int(r["a"]) + int(r["b"]) and r["n"] == str(-int(r["a"]))


def test_what_is_no_amount_is_none(spark):
    df = spark.createDataFrame([("12x",), ("",), ("9" * 79,), (None,)], "v string")
    assert [r[0] for r in df.select(wide.plus(F.col("v"), F.lit("1"))).collect()] == [None] * 4


@pytest.fixture()
def wide_lake(spark, scratch):
    """Transfers whose daily sum passes 38 digits though no amount does, and one of 78."""
    flow_tables(spark, scratch)
    a, b, p, q = TOKENS[0], TOKENS[1], POOLS[0], POOLS[1]
    most = "9" * 38
    write(spark, scratch, "erc20.ERC20_evt_Transfer",
          [(a, POOLS[3], p, most, day(2)), (a, POOLS[3], p, most, day(2)), (a, p, POOLS[3], most, day(4)), (b, POOLS[3], q, str(BIG), day(3))],
          "contract_address binary, from binary, to binary, value string, evt_block_time timestamp")
    write(spark, scratch, "erc20.token_balances",
          [(p, a, "5", day(1)), (p, a, str(BIG), day(2)), (p, a, most, day(4))],
          "wallet_address binary, token_address binary, amount_raw string, timestamp timestamp")
    write(spark, scratch, "sushi.Factory_evt_PairCreated", [(a, b, p, day(1))], "token0 binary, token1 binary, pair binary, evt_block_time timestamp")
    return scratch


def test_flow_job_sums_past_38_digits_and_quarantines_what_does_not_fit(spark, wide_lake):
    t = chain.ChainTables(spark, base=wide_lake)
    rows = chain.balancer_flows_window(t, "2021-07-01", "2021-07-06")
    got = {(r["pool_address"][0], r["block_time"].day): (r["token_amount_raw"], r["amount_text"]) for r in rows.collect()}
    twice = str(2 * int("9" * 38))
    assert got[(1, 2)] == got[(1, 3)] == (None, twice)
    assert (int(got[(1, 4)][0]), got[(1, 4)][1]) == (int("9" * 38), None)
    assert got[(2, 5)] == (None, str(BIG))


def test_stored_job_keeps_wide_rows_out_of_the_fact_and_in_quarantine(spark, wide_lake):
    from poolbook import schemas

    t = chain.ChainTables(spark, base=wide_lake)
    src = chain.sources_for(t, "sushiswap_v1")
    table = polling.liquidity_table(os.path.join(wide_lake, "fact"), schemas.LIQUIDITY, "Sushiswap", "1")
    job = lambda s, e, stored: build_window(JOBS["sushiswap_v1"], src, s, e, stored=stored)
    for _ in range(2):
        polling.backfill(spark, job, table, [("2021-07-01", "2021-07-06")], skip_filled=False)
        fact = {r["day"].day: int(r["token_amount_raw"]) for r in polling.stored_table(spark, table).collect()}
        bad = {r["day"].day: (r["token_amount_raw"], r["amount_text"], r["token_amount"]) for r in polling.quarantine_table(spark, table).collect()}
        assert fact == {1: 5, 4: int("9" * 38), 5: int("9" * 38)}
        assert bad == {2: (None, str(BIG), float(BIG)), 3: (None, str(BIG), float(BIG))}
    assert polling.quarantine_table(spark, table).count() == 2
