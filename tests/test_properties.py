"""Properties of the forward fill and the window build."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poolbook.operators import fill, pools
from poolbook.plans import catalog as C
from poolbook.plans import jobs as J
from poolbook.schemas import LIQUIDITY_KEY

SF = "/root/testdata/sf0.001"
KEYS = ["wallet_address", "token_address"]
SCHEMA = "wallet_address binary, token_address binary, amount_raw decimal(38,0), timestamp timestamp_ntz, tie long"
W = [bytes([1] * 20), bytes([2] * 20)]
T = [bytes([9] * 20), bytes([8] * 20)]

changes_st = st.lists(
    st.tuples(st.sampled_from(W), st.sampled_from(T), st.integers(0, 10**30), st.integers(0, 9 * 24 - 1),
              st.integers(0, 59)),
    min_size=1, max_size=25)


def _log(spark, rows):
    data = [(w, t, Decimal(v), dt.datetime(2021, 7, 1) + dt.timedelta(hours=h, minutes=m), i)
            for i, (w, t, v, h, m) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=changes_st, split=st.integers(2, 9))
def test_chained_windows_equal_one_full_run(spark, rows, split):
    log = _log(spark, rows)
    start, mid, end = dt.date(2021, 7, 1), dt.date(2021, 7, split), dt.date(2021, 7, 12)
    full = fill.forward_fill_daily(fill.in_window(log, "timestamp", start, end), KEYS, "amount_raw", "timestamp",
                                   start, end, tie="tie")
    first = fill.forward_fill_daily(fill.in_window(log, "timestamp", start, mid), KEYS, "amount_raw", "timestamp",
                                    start, mid, tie="tie")
    seeds = fill.seed_rows(first, mid, 3)
    chained_log = fill.seeded_changes(fill.in_window(log, "timestamp", mid, end), seeds, "timestamp", "amount_raw")
    second = fill.forward_fill_daily(chained_log, KEYS, "amount_raw", "timestamp", mid, end, rank="_src_rank", tie="tie")
    cols = ["day", *KEYS, "amount_raw"]
    assert sorted(first.select(cols).unionByName(second.select(cols)).collect()) == sorted(full.select(cols).collect())


def test_no_gap_between_first_day_and_window_end(spark):
    out = C.q_daily_forward_fill(spark, SF)
    per_key = out.groupBy(*KEYS).agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.count(F.lit(1)).alias("n"))
    bad = per_key.where((F.datediff("hi", "lo") + 1 != F.col("n")) | (F.col("hi") != F.lit(dt.date(2024, 2, 2))))
    assert bad.count() == 0


def test_window_rows_have_unique_keys(spark):
    out = C.q_job_pair(spark, SF)
    assert out.groupBy(*LIQUIDITY_KEY).count().where("count > 1").count() == 0


def test_duplicated_registry_rows_change_nothing(spark):
    from poolbook.sources import standins as S

    def run(registry):
        src = C._sources(spark, SF, registry)
        return sorted((tuple(r) for r in J.build_window(C.PAIR_JOB, src, "2024-01-01", "2024-02-01").collect()), key=repr)

    once = run(lambda: S.pair_registry(spark, SF))
    twice = run(lambda: S.pair_registry(spark, SF).unionByName(S.pair_registry(spark, SF)))
    assert once == twice


def test_binary_exclusion_list_from_hex_text(spark):
    df = spark.createDataFrame([(bytes.fromhex("ed9c854cb02de75ce4c9bba992828d6cb7fd5c71"),), (bytes([1] * 20),)],
                               "wallet_address binary")
    kept = pools.exclude_pools(df, ["0xED9C854CB02DE75CE4C9BBA992828D6CB7FD5C71"]).collect()
    assert [bytes(r[0]) for r in kept] == [bytes([1] * 20)]


def test_delta_job_keys_pools_by_id_prefix(spark):
    pid = bytes(range(32))
    deltas = spark.createDataFrame([(pid, b"t", Decimal(7), dt.datetime(2021, 7, 1, 5))],
                                   "pool binary, token binary, delta decimal(38,0), ts timestamp_ntz")
    defs = spark.createDataFrame([(pid[:20], b"t", 0.5, "X")],
                                 "pool_address binary, token_address binary, normalized_weight double, pool_name_symbolic string")
    tokens = spark.createDataFrame([], "contract_address binary, symbol string, decimals int")
    prices = spark.createDataFrame([], "contract_address binary, minute timestamp_ntz, price double")
    out = J.build_deltas_window(deltas, defs, tokens, prices, "2021-07-01", "2021-07-03", pool_prefix_len=20).collect()
    assert len(out) == 2
    assert all(bytes(r["pool_address"]) == pid[:20] and r["token_pool_percentage"] == 0.5 for r in out)
    assert out[0]["pool_name"] == "Balancer v2 LP X"
