"""State kept between runs: membership, pool names, flow balances."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from poolbook.plans import jobs as J
from poolbook.plans import run as cli
from poolbook.plans.config import JOBS
from poolbook.sources import chain
from poolbook.streaming import state
from tests.plan_util import plan_text

POOLS = [bytes([i]) * 20 for i in range(1, 5)]
TOKENS = [bytes([i]) * 20 for i in range(11, 15)]
MEMBERS = "pool string, token string"
TRANSFERS = "contract_address string, from string, to string, evt_block_time timestamp_ntz"


def day(d, hour=10):
    return dt.datetime(2021, 7, d, hour)


def transfers(spark, scratch):
    rows = [("A", "x", "p", day(1)), ("B", "p", "q", day(2)), ("A", "x", "late", day(2)), ("C", "x", "p", day(6)),
            ("A", "x", "p", day(7)), (None, "x", "p", day(7)), ("D", "x", "late", day(8)), ("E", "x", "nobody", day(8))]
    path = os.path.join(scratch, "transfers.parquet")
    spark.createDataFrame(rows, TRANSFERS).write.parquet(path)
    return spark.read.parquet(path)


def pairs(table, spark):
    return sorted(tuple(r) for r in table.rows(spark).collect())


def test_members_extended_in_steps_equal_members_of_the_whole_log(spark, scratch):
    t = transfers(spark, scratch)
    schema = spark.createDataFrame([], MEMBERS).schema
    registry = spark.createDataFrame([("p",), ("q",)], "pool string")
    everyone = registry.union(spark.createDataFrame([("late",), (None,)], "pool string"))
    members = state.MarkedTable(os.path.join(scratch, "members"), schema)
    known = state.MarkedTable(os.path.join(scratch, "pools"), registry.schema)
    added = [state.extend_transfer_members(spark, members, known, t, r, end)
             for r, end in ((registry, "2021-07-03"), (registry, "2021-07-07"), (everyone, "2021-07-20"), (everyone, "2021-07-20"))]
    whole = state.MarkedTable(os.path.join(scratch, "whole"), schema)
    state.extend_transfer_members(spark, whole, state.MarkedTable(os.path.join(scratch, "w"), registry.schema), t, everyone, "2021-07-20")
    assert added == [2, 1, 2, 0]
    assert pairs(members, spark) == pairs(whole, spark) == [("late", "A"), ("late", "D"), ("p", "A"), ("p", "C"), ("q", "B")]


@pytest.mark.parametrize("late", [False, True])
def test_an_extension_reads_only_what_follows_the_mark(spark, scratch, monkeypatch, late):
    t = transfers(spark, scratch)
    registry = spark.createDataFrame([("p", day(1))], "pool string, since timestamp_ntz")
    members = state.MarkedTable(os.path.join(scratch, "members"), spark.createDataFrame([], MEMBERS).schema)
    known = state.MarkedTable(os.path.join(scratch, "pools"), registry.select("pool").schema)
    state.extend_transfer_members(spark, members, known, t, registry, "2021-07-05")
    read, between = [], state._between
    monkeypatch.setattr(state, "_between", lambda *a: read.append(between(*a)) or read[-1])
    # a pool registered after the mark has no older transfers; one that merely turned up may
    new = spark.createDataFrame([("late", day(2 if late else 6))], registry.schema)
    state.extend_transfer_members(spark, members, known, t, registry.union(new), "2021-07-20", registered="since")
    scans = [plan_text(df) for df in read if "evt_block_time" in df.columns]
    assert len(scans) == (2 if late else 1)
    assert "GreaterThanOrEqual(evt_block_time,2021-07-05T00:00)" in scans[0]
    assert "LessThan(evt_block_time,2021-07-20T00:00)" in scans[0]
    assert ("late", "A") in pairs(members, spark) if late else ("late", "A") not in pairs(members, spark)


def test_an_extension_that_died_before_its_mark_is_repeated(spark, scratch, monkeypatch):
    rows = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", "B")], MEMBERS)
    table = state.MarkedTable(os.path.join(scratch, "m"), rows.schema)
    with monkeypatch.context() as broken:
        broken.setattr(state._Marked, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.extend(spark, lambda since, end: rows, "2021-07-02")
    assert table.mark(spark) is None
    assert table.extend(spark, lambda since, end: rows, "2021-07-03") == 0
    assert pairs(table, spark) == [("p", "A"), ("p", "B")]
    assert table.mark(spark) == dt.date(2021, 7, 3)


def test_half_written_snapshots_are_not_read(spark, scratch, monkeypatch):
    rows = spark.createDataFrame([(1,)], "n int")
    table = state.SnapshotTable(os.path.join(scratch, "s"), rows.schema)
    assert table.latest(spark) is None
    table.write(rows, "2021-07-01")
    with monkeypatch.context() as broken:
        broken.setattr(state._Marked, "_record", lambda *a: None)
        table.write(rows.withColumn("n", F.lit(2)), "2021-07-02")
    assert table.latest(spark)[0] == dt.date(2021, 7, 1)
    table.write(rows.withColumn("n", F.lit(3)), "2021-07-02")
    assert [r["n"] for r in table.latest(spark)[1].collect()] == [3]
    assert table.latest(spark, before="2021-07-02")[0] == dt.date(2021, 7, 1)


# ---- jobs over chain tables ---------------------------------------------------------
def write(spark, base, qualified, rows, schema):
    schema_name, table = qualified.split(".", 1)
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(base, schema_name, f"{table}.parquet"))


def flow_tables(spark, base, weekend=()):
    a, b = TOKENS[0], TOKENS[1]
    p, q = POOLS[0], POOLS[1]
    write(spark, base, "erc20.ERC20_evt_Transfer",
          [(a, POOLS[3], p, Decimal(100), day(2)), (a, p, POOLS[3], Decimal(30), day(6)), (b, POOLS[3], q, Decimal(7), day(1))],
          "contract_address binary, from binary, to binary, value decimal(38,0), evt_block_time timestamp")
    write(spark, base, "balancer.BFactory_evt_LOG_NEW_POOL", [(p,), (q,)], "pool binary")
    write(spark, base, "balancer_v2.Vault_evt_Swap", [],
          "poolId binary, tokenIn binary, amountIn decimal(38,0), tokenOut binary, amountOut decimal(38,0), evt_block_time timestamp")
    write(spark, base, "balancer_v2.Vault_evt_PoolBalanceChanged", [], "poolId binary, tokens array<binary>, deltas array<decimal(38,0)>, evt_block_time timestamp")
    write(spark, base, "balancer_v2.Vault_evt_PoolBalanceManaged", [], "poolId binary, token binary, cashDelta decimal(38,0), managedDelta decimal(38,0), evt_block_time timestamp")
    write(spark, base, "balancer_v2.Vault_evt_InternalBalanceChanged", [], "token binary, delta decimal(38,0), evt_block_time timestamp")
    write(spark, base, "erc20.tokens", [(a, "AAA", 0), (b, "BBB", 0)], "contract_address binary, symbol string, decimals int")
    write(spark, base, "prices.usd", [(t, day(d, 0), 2.0) for t in (a, b) for d in range(1, 10) if d not in weekend],
          "contract_address binary, minute timestamp, price double")
    write(spark, base, "dex.view_token_prices", [], "contract_address binary, hour timestamp, median_price double, sample_size bigint")
    write(spark, base, "balancer.view_pools_tokens_weights", [(p, a, 0.5), (q, b, 0.5)], "pool_id binary, token_address binary, normalized_weight double")


def fact(df):
    return sorted((r["pool_address"][0], r["block_time"].day, int(r["token_amount_raw"]), int(r["delta_token_amount_raw"]), r["version"])
                  for r in df.collect())


def test_flow_job_restarted_from_its_fact_rows_has_no_hole(spark, scratch):
    flow_tables(spark, scratch)
    t = chain.ChainTables(spark, base=scratch)
    full = fact(chain.balancer_flows_window(t, "2021-07-01", "2021-07-08"))
    first = chain.balancer_flows_window(t, "2021-07-01", "2021-07-04")
    second = chain.balancer_flows_window(t, "2021-07-04", "2021-07-08", stored=first)
    assert (1, 4, 100, 100, "1") in full and (1, 7, 70, -30, "1") in full
    assert sorted(fact(first) + fact(second)) == full


def test_flow_job_restarted_from_closing_balances_needs_no_fact_row(spark, scratch):
    flow_tables(spark, scratch, weekend=(3, 4))  # the split day has no price, so no fact rows
    t = chain.ChainTables(spark, base=scratch)
    full = fact(chain.balancer_flows_window(t, "2021-07-01", "2021-07-08"))
    closed = chain.flow_state_table(os.path.join(scratch, "state"))
    parts = [fact(chain.balancer_flows_window(t, s, e, state=closed))
             for s, e in (("2021-07-01", "2021-07-04"), ("2021-07-04", "2021-07-06"), ("2021-07-06", "2021-07-08"))]
    assert sum(parts, []) and sorted(sum(parts, [])) == full
    again = fact(chain.balancer_flows_window(t, "2021-07-05", "2021-07-08", state=closed))  # a refresh with overlap
    assert again == [r for r in full if r[1] >= 5]


def test_command_line_keeps_members_and_names_between_runs(spark, scratch, monkeypatch, capsys):
    lake, target, kept = (os.path.join(scratch, n) for n in ("lake", "target", "state"))
    a, b, c = TOKENS[:3]
    p, q = POOLS[:2]
    token = "contract_address binary, symbol string, decimals int"
    write(spark, lake, "erc20.tokens", [(a, "AAA", 0), (b, "BBB", 0), (c, "CCC", 0)], token)
    write(spark, lake, "prices.usd", [], "contract_address binary, minute timestamp, price double")
    write(spark, lake, "erc20.token_balances", [(p, a, Decimal(1), day(1)), (q, c, Decimal(2), day(6))],
          "wallet_address binary, token_address binary, amount_raw decimal(38,0), timestamp timestamp")
    write(spark, lake, "sushi.Factory_evt_PairCreated", [(a, b, p, day(1)), (a, c, q, day(5))],
          "token0 binary, token1 binary, pair binary, evt_block_time timestamp")
    write(spark, lake, "curvefi.view_trades", [(p, a, b, day(1)), (q, c, a, day(5))],
          "exchange_contract_address binary, token_a_address binary, token_b_address binary, block_time timestamp")
    args = ["--lake", lake, "--state", kept]
    for job in ("sushiswap_v1", "curve_v1"):
        own = [*args, "--job", job, "--target", target + job]
        assert cli.main(["backfill", *own, "--window", "2021-07-01", "2021-07-04"], spark=spark)["inserted"] == [3]
    write(spark, lake, "erc20.tokens", [(a, "AA2", 0), (b, "BBB", 0), (c, "CCC", 0)], token)
    t = chain.ChainTables(spark, base=lake)
    names = chain.refresh_label_slice(t, "sushiswap_v1", kept, "2021-07-09")
    assert sorted(r["label"] for r in state.stored_labels(spark, names).collect()) == ["Sushi v1 LP AA2 - BBB", "Sushi v1 LP AA2 - CCC"]
    members = chain.extend_members(t, "curve_v1", kept, "2021-07-09")
    assert members.rows(spark).count() == 4
    src = chain.sources_for(t, "curve_v1", members=members)
    out = J.build_window(JOBS["curve_v1"], src, "2021-07-06", "2021-07-08")
    assert out.count() == 2 and "view_trades" not in plan_text(out)
    src = chain.sources_for(t, "sushiswap_v1", names=names)
    plan = plan_text(J.build_window(JOBS["sushiswap_v1"], src, "2021-07-06", "2021-07-08"))
    assert plan.count("closing=2021-07-09") >= 1 and plan.count("PairCreated.parquet") <= 2  # positions only, once an arm
