"""Jobs over chain-shaped tables (binary addresses, upstream column names)."""

import datetime as dt
import os
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from poolbook.plans.config import JOBS, UNISWAP_V2_EXCLUDED_POOLS
from poolbook.plans.jobs import build_window
from poolbook.sources.chain import ChainTables, pool_labels, sources_for
from tests.plan_util import plan_text

# The reference's literal fixture: (token, pool) pairs of two pools.
T_1INCH = bytes.fromhex("111111111117dc0aa78b770fa6a738034120c302")
T_AUDIO = bytes.fromhex("18aaa7115705e8be94bffebde57af9bfc265b998")
T_888 = bytes.fromhex("888888888889c00c67689029d7856aac1065ec11")
P_A = bytes.fromhex("4d5f08eccd3d9281632aa3fc6937e98441564544")
P_B = bytes.fromhex("dc1534a2817bfccd9b6637fb184588e7842805f0")
WETH = bytes.fromhex("c02aaa39b223fe8d0a0e5c4f27ead9083c756cc2")
WASH = bytes.fromhex(UNISWAP_V2_EXCLUDED_POOLS[0][2:])


def _write(spark, base, qualified, rows, schema):
    schema_name, table = qualified.split(".", 1)
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(
        os.path.join(base, schema_name, f"{table}.parquet"))


def _fixture(spark, base):
    ts = lambda d, h=10: dt.datetime(2021, 7, d, h)
    _write(spark, base, "uniswap_v2.Factory_evt_PairCreated",
           [(T_1INCH, T_888, P_A), (T_AUDIO, WETH, P_B), (T_1INCH, WETH, WASH), (T_1INCH, T_888, P_A)],
           "token0 binary, token1 binary, pair binary")
    _write(spark, base, "erc20.token_balances",
           [(P_A, T_1INCH, Decimal(100), ts(1)), (P_A, T_1INCH, Decimal(150), ts(3)),
            (P_A, T_888, Decimal(7), ts(2)), (P_B, T_AUDIO, Decimal(10**30), ts(4)),
            (P_B, T_888, Decimal(5), ts(1)),            # token not in pool B: dropped
            (WASH, T_1INCH, Decimal(9), ts(1)),         # excluded pool
            (P_A, T_1INCH, Decimal(1), ts(6))],         # after the window
           "wallet_address binary, token_address binary, amount_raw decimal(38,0), timestamp timestamp")
    _write(spark, base, "erc20.tokens",
           [(T_1INCH, "1INCH", 2), (T_888, None, 18), (T_AUDIO, "AUDIO", 18)],
           "contract_address binary, symbol string, decimals int")
    _write(spark, base, "prices.usd",
           [(T_1INCH, dt.datetime(2021, 7, 3), 2.0), (T_1INCH, dt.datetime(2021, 7, 3, 0, 1), 9.0)],
           "contract_address binary, minute timestamp, price double")


def test_pair_job_on_chain_tables(spark, scratch):
    _fixture(spark, scratch)
    t = ChainTables(spark, base=scratch)
    out = build_window(JOBS["uniswap_v2"], sources_for(t, "uniswap_v2", with_labels=False), "2021-07-01", "2021-07-06")
    rows = {(bytes(r["pool_address"]), bytes(r["token_address"]), r["day"].day): r for r in out.collect()}
    assert {(p, tk) for p, tk, _ in rows} == {(P_A, T_1INCH), (P_A, T_888), (P_B, T_AUDIO)}
    a = [rows[(P_A, T_1INCH, d)] for d in range(1, 6)]
    assert [int(r["token_amount_raw"]) for r in a] == [100, 100, 150, 150, 150]
    assert a[2]["token_amount"] == 1.5 and a[2]["token_usd_amount"] == 3.0 and a[3]["token_usd_amount"] is None
    assert all(r["token_index"] == "token_0" for r in a)
    assert rows[(P_A, T_888, 2)]["token_index"] == "token_1" and rows[(P_A, T_888, 2)]["token_symbol"] is None
    assert int(rows[(P_B, T_AUDIO, 5)]["token_amount_raw"]) == 10**30
    assert rows[(P_B, T_AUDIO, 5)]["token_amount"] == 1e12
    assert out.groupBy("day", "pool_address", "token_address").count().where("count > 1").count() == 0


def test_equal_block_times_and_repeated_dimension_rows(spark, scratch):
    """The winner of two changes in one block does not depend on their order,
    and repeated token or price rows do not multiply the output."""
    _fixture(spark, scratch)
    at = dt.datetime(2021, 7, 1, 10)
    rows = [(P_A, T_1INCH, Decimal(n), at) for n in (100, 101, 102)]
    schema = "wallet_address binary, token_address binary, amount_raw decimal(38,0), timestamp timestamp"
    _write(spark, scratch, "erc20.tokens", [(T_1INCH, "1INCH", 2), (T_1INCH, None, 2), (T_1INCH, "1INCH", 2)],
           "contract_address binary, symbol string, decimals int")
    _write(spark, scratch, "prices.usd", [(T_1INCH, dt.datetime(2021, 7, 1), p) for p in (3.0, 2.0)],
           "contract_address binary, minute timestamp, price double")
    seen = []
    for given in (rows, rows[::-1]):
        _write(spark, scratch, "erc20.token_balances", given, schema)
        t = ChainTables(spark, base=scratch)
        seen.append(build_window(JOBS["uniswap_v2"], sources_for(t, "uniswap_v2"), "2021-07-01", "2021-07-02").collect())
    assert seen[0] == seen[1] and len(seen[0]) == 1
    row = seen[0][0]
    assert row["token_symbol"] == "1INCH" and row["token_usd_amount"] == row["token_amount"] * 2.0


def test_label_sets_on_chain_tables(spark, scratch):
    _fixture(spark, scratch)
    e = "token binary, exchange binary"
    _write(spark, scratch, "uniswap.Factory_evt_NewExchange", [(T_1INCH, P_B)], e)
    for q in ("uniswap_v3.Factory_evt_PoolCreated",):
        _write(spark, scratch, q, [(T_1INCH, T_AUDIO, P_B)], "token0 binary, token1 binary, pool binary")
    _write(spark, scratch, "sushi.Factory_evt_PairCreated", [], "token0 binary, token1 binary, pair binary")
    m = "token1 binary, token2 binary, mooniswap binary"
    _write(spark, scratch, "mooniswap.MooniFactory_evt_Deployed", [(T_AUDIO, T_1INCH, P_A)], m)
    _write(spark, scratch, "onelp.MooniswapFactory_evt_Deployed", [], m)
    _write(spark, scratch, "bancor.StandardPoolConverter_evt_LiquidityAdded",
           [(P_A, bytes.fromhex("eeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeee")),
            (P_A, bytes.fromhex("1f573d6fb3f13d689ff844b4ce37794d79a7ff1c"))],
           "contract_address binary, _reserveToken binary")
    _write(spark, scratch, "erc20.tokens",
           [(T_1INCH, "1INCH", 2), (T_888, None, 18), (T_AUDIO, "AUDIO", 18), (WETH, "WETH", 18)],
           "contract_address binary, symbol string, decimals int")
    labels = {(bytes(r["address"]), r["label"]) for r in pool_labels(ChainTables(spark, base=scratch)).collect()}
    assert labels == {
        (P_B, "Uni v1 LP 1INCH - ETH"),
        (P_B, "Uni v2 LP AUDIO - WETH"),
        (P_B, "Uni v3 LP 1INCH - AUDIO"),
        (P_A, "Mooniswap v1 LP AUDIO - 1INCH"),
        (P_A, "Bancor LP WETH - BNT"),
        (WASH, "Uni v2 LP 1INCH - WETH"),
    }


def test_label_lookups_never_broadcast_the_tokens(spark, scratch):
    """The token dimension grows: however small it is here, its lookups are hash joins
    over shuffles, and repeated and null keys count as in any inner join."""
    e = "token binary, exchange binary"
    _write(spark, scratch, "uniswap.Factory_evt_NewExchange", [(T_888, P_A), (None, P_B), (T_888, P_A)], e)
    pair = "token0 binary, token1 binary, pair binary"
    _write(spark, scratch, "uniswap_v2.Factory_evt_PairCreated", [(T_1INCH, WETH, P_A), (T_1INCH, None, P_B), (T_888, WETH, None)], pair)
    _write(spark, scratch, "uniswap_v3.Factory_evt_PoolCreated", [], "token0 binary, token1 binary, pool binary")
    _write(spark, scratch, "sushi.Factory_evt_PairCreated", [], pair)
    for q in ("mooniswap.MooniFactory_evt_Deployed", "onelp.MooniswapFactory_evt_Deployed"):
        _write(spark, scratch, q, [], "token1 binary, token2 binary, mooniswap binary")
    _write(spark, scratch, "bancor.StandardPoolConverter_evt_LiquidityAdded", [(P_B, T_888), (P_B, T_888), (P_B, T_1INCH)],
           "contract_address binary, _reserveToken binary")
    _write(spark, scratch, "erc20.tokens",
           [(T_1INCH, "1INCH", 2), (T_1INCH, None, 2), (T_888, "888", 18), (T_888, "888", 18), (WETH, "WETH", 18), (None, "NONE", 1)],
           "contract_address binary, symbol string, decimals int")
    out = pool_labels(ChainTables(spark, base=scratch))
    plan = plan_text(out, "simple")
    assert "ShuffledHashJoin" in plan
    assert "Broadcast" not in plan and "SortMergeJoin" not in plan
    labels = Counter((r["address"] and bytes(r["address"]), r["label"]) for r in out.collect())
    assert labels == {
        (P_A, "Uni v1 LP 888 - ETH"): 4,
        (P_A, "Uni v2 LP 1INCH - WETH"): 1,
        (None, "Uni v2 LP 888 - WETH"): 2,
        (P_B, "Bancor LP 888 - BNT"): 2,
        (P_B, "Bancor LP 1INCH - BNT"): 1,
    }


def test_balancer_v2_by_pool_from_vault_events(spark, scratch):
    from poolbook.sources.chain import balancer_v2_window

    _fixture(spark, scratch)
    pid = P_A + bytes(range(12))
    h = bytes([7] * 32)
    w = lambda q, rows, schema: _write(spark, scratch, q, rows, schema)
    w("balancer_v2.Vault_evt_PoolRegistered", [(pid, h)], "poolId binary, evt_tx_hash binary")
    create = "call_tx_hash binary, tokens array<binary>, weights array<decimal(20,0)>, symbol string"
    w("balancer_v2.WeightedPoolFactory_call_create",
      [(h, [T_1INCH, T_888], [Decimal(6 * 10**17), Decimal(4 * 10**17)], "B-60-40")], create)
    w("balancer_v2.WeightedPool2TokensFactory_call_create", [], create)
    w("balancer_v2.StablePoolFactory_call_create", [], "call_tx_hash binary, tokens array<binary>, symbol string")
    w("balancer_v2.Vault_evt_Swap", [(pid, T_1INCH, Decimal(100), T_888, Decimal(30), dt.datetime(2021, 7, 2, 10))],
      "poolId binary, tokenIn binary, amountIn decimal(38,0), tokenOut binary, amountOut decimal(38,0), evt_block_time timestamp")
    w("balancer_v2.Vault_evt_PoolBalanceChanged",
      [(pid, [T_1INCH, T_888], [Decimal(1000), Decimal(500)], dt.datetime(2021, 7, 1, 9))],
      "poolId binary, tokens array<binary>, deltas array<decimal(38,0)>, evt_block_time timestamp")
    w("balancer_v2.Vault_evt_PoolBalanceManaged",
      [(pid, T_888, Decimal(5), Decimal(-5), dt.datetime(2021, 7, 3, 1))],
      "poolId binary, token binary, cashDelta decimal(38,0), managedDelta decimal(38,0), evt_block_time timestamp")
    t = ChainTables(spark, base=scratch)

    def amounts(df):
        return {(bytes(r["token_address"]), r["day"].day): (int(r["token_amount_raw"]), r["token_pool_percentage"],
                                                          r["pool_name"], bytes(r["pool_address"])) for r in df.collect()}

    full = amounts(balancer_v2_window(t, "2021-07-01", "2021-07-05"))
    assert {k: v[0] for k, v in full.items()} == {
        (T_1INCH, 1): 1000, (T_1INCH, 2): 1100, (T_1INCH, 3): 1100, (T_1INCH, 4): 1100,
        (T_888, 1): 500, (T_888, 2): 470, (T_888, 3): 470, (T_888, 4): 470}
    assert full[(T_1INCH, 1)][1:] == (0.6, "Balancer v2 LP B-60-40", P_A)
    # Chained: the second window starts from the stored rows of the day before.
    first = balancer_v2_window(t, "2021-07-01", "2021-07-03")
    second = amounts(balancer_v2_window(t, "2021-07-03", "2021-07-05", stored=first))
    assert second == {k: v for k, v in full.items() if k[1] >= 3}


def test_command_line_backfill_and_refresh(spark, scratch):
    from poolbook.plans.run import main

    _fixture(spark, scratch)
    target = os.path.join(scratch, "out", "liquidity")
    lake = ["--lake", scratch, "--target", target, "--job", "uniswap_v2"]
    # the fixture holds no other exchange's registry: a job reads its own label set
    r1 = main(["backfill", *lake, "--window", "2021-07-01", "2021-07-04", "--window", "2021-07-04", "2021-07-06"],
              spark=spark)
    r2 = main(["refresh", *lake, "--as-of", "2021-07-07T00:30:00"], spark=spark)
    assert sum(r1["inserted"]) == 11          # 5 + 4 + 2 days from each pair's first change to 07-05
    assert r2["inserted"] == 3                # day 07-06 is new; the overlap days are already stored
    stored = spark.read.parquet(target)
    assert stored.groupBy("day", "pool_address", "token_address").count().where("count > 1").count() == 0


def _balancer_fixture(spark, base):
    """Balancer v1 pool P_B and v2 pool (id prefix P_A); vault-held balances."""
    from poolbook.plans.config import BALANCER_V2_VAULT

    _fixture(spark, base)
    w = lambda q, rows, schema: _write(spark, base, q, rows, schema)
    pid = P_A + bytes(range(12))
    h = bytes([7] * 32)
    vault = bytes.fromhex(BALANCER_V2_VAULT[2:])
    w("balancer_v2.Vault_evt_PoolRegistered", [(pid, h)], "poolId binary, evt_tx_hash binary")
    create = "call_tx_hash binary, tokens array<binary>, weights array<decimal(20,0)>, symbol string"
    w("balancer_v2.WeightedPoolFactory_call_create",
      [(h, [T_1INCH, T_888], [Decimal(6 * 10**17), Decimal(4 * 10**17)], "B-60-40")], create)
    w("balancer_v2.WeightedPool2TokensFactory_call_create", [], create)
    w("balancer_v2.StablePoolFactory_call_create", [], "call_tx_hash binary, tokens array<binary>, symbol string")
    w("balancer_v2.Vault_evt_Swap", [(pid, T_1INCH, Decimal(100), T_888, Decimal(30), dt.datetime(2021, 7, 2, 10))],
      "poolId binary, tokenIn binary, amountIn decimal(38,0), tokenOut binary, amountOut decimal(38,0), evt_block_time timestamp")
    w("balancer_v2.Vault_evt_PoolBalanceChanged",
      [(pid, [T_1INCH, T_888], [Decimal(1000), Decimal(500)], dt.datetime(2021, 7, 1, 9))],
      "poolId binary, tokens array<binary>, deltas array<decimal(38,0)>, evt_block_time timestamp")
    w("balancer_v2.Vault_evt_PoolBalanceManaged", [],
      "poolId binary, token binary, cashDelta decimal(38,0), managedDelta decimal(38,0), evt_block_time timestamp")
    w("balancer_v2.Vault_evt_InternalBalanceChanged", [(T_1INCH, Decimal(3), dt.datetime(2021, 7, 1, 1))],
      "token binary, delta decimal(38,0), evt_block_time timestamp")
    w("balancer.BFactory_evt_LOG_NEW_POOL", [(P_B,)], "pool binary")
    w("erc20.ERC20_evt_Transfer",
      [(T_1INCH, WETH, P_B, Decimal(50), dt.datetime(2021, 7, 1, 3)),
       (T_1INCH, P_B, WETH, Decimal(20), dt.datetime(2021, 7, 2, 3))],
      "contract_address binary, from binary, to binary, value decimal(38,0), evt_block_time timestamp")
    w("dex.view_token_prices", [(T_1INCH, dt.datetime(2021, 7, 3, 1), 4.0, 5)],
      "contract_address binary, hour timestamp, median_price double, sample_size bigint")
    w("balancer.view_pools_tokens_weights", [(P_B, T_1INCH, 0.5), (pid, T_1INCH, 0.6)],
      "pool_id binary, token_address binary, normalized_weight double")
    w("erc20.token_balances",
      [(vault, T_1INCH, Decimal(77), dt.datetime(2021, 7, 1, 4)), (vault, WETH, Decimal(5), dt.datetime(2021, 7, 1, 4))],
      "wallet_address binary, token_address binary, amount_raw decimal(38,0), timestamp timestamp")
    return pid, vault


def test_balancer_vault_totals_on_chain_tables(spark, scratch):
    from poolbook.sources.chain import balancer_v2_vault_window

    _, vault = _balancer_fixture(spark, scratch)
    out = balancer_v2_vault_window(ChainTables(spark, base=scratch), "2021-07-01", "2021-07-03").collect()
    # only tokens of a registered v2 pool count: 1INCH yes, WETH no
    assert {(bytes(r["pool_address"]), bytes(r["token_address"]), r["day"].day, int(r["token_amount_raw"]))
            for r in out} == {(vault, T_1INCH, 1, 77), (vault, T_1INCH, 2, 77)}
    assert all(r["token_pool_percentage"] is None and r["token_index"] == "token_x" for r in out)


def test_balancer_flows_on_chain_tables(spark, scratch):
    from poolbook.sources.chain import balancer_flows_window

    pid, _ = _balancer_fixture(spark, scratch)
    out = balancer_flows_window(ChainTables(spark, base=scratch), "2021-07-01", "2021-07-05").collect()
    got = {(bytes(r["pool_address"]), r["block_time"].day): (int(r["token_amount_raw"]), r["usd_amount"], r["version"])
           for r in out}
    # v1 pool P_B: +50 on day 1, -20 on day 2; 1INCH (2 decimals) priced 2.0 on day 3
    # (midnight minute price averaged with the 00:01 one: (2 + 9) / 2 = 5.5), else
    # the day-3 sparse median 4.0 carried from day 3 on.  Days 1-2 have no price.
    assert got == {
        (P_B, 3): (30, 30 / 100 * 5.5, "1"),
        (P_B, 4): (30, 30 / 100 * 4.0, "1"),
        (pid, 3): (1100, 1100 / 100 * 5.5, "2"),
        (pid, 4): (1100, 1100 / 100 * 4.0, "2"),
    }


def test_command_line_flow_fact(spark, scratch):
    from poolbook.plans.run import main

    _balancer_fixture(spark, scratch)
    target = os.path.join(scratch, "out", "view_liquidity")
    args = ["--lake", scratch, "--target", target, "--job", "balancer_flows"]
    r = main(["backfill", *args, "--window", "2021-07-01", "2021-07-05"], spark=spark)
    assert r["inserted"] == [4]
    assert main(["backfill", *args, "--window", "2021-07-01", "2021-07-05"], spark=spark)["inserted"] == [0]
    stored = spark.read.parquet(target)
    assert sorted(r["month"] for r in stored.select("month").distinct().collect()) == ["2021-07"]
