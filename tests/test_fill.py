"""Forward-fill cases (C1, C2, J4, J5) on hand-made binary-address fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolbook.operators import fill

POOL = bytes.fromhex("4d5f08eccd3d9281632aa3fc6937e98441564544")
TOKEN = bytes.fromhex("111111111117dc0aa78b770fa6a738034120c302")
SCHEMA = T.StructType([
    T.StructField("wallet_address", T.BinaryType()),
    T.StructField("token_address", T.BinaryType()),
    T.StructField("amount_raw", T.DecimalType(38, 0)),
    T.StructField("timestamp", T.TimestampNTZType()),
])
KEYS = ["wallet_address", "token_address"]


def ts(day, hour=12):
    return dt.datetime(2021, 7, day, hour)


def changes(spark, rows):
    return spark.createDataFrame([(POOL, TOKEN, Decimal(v), t) for v, t in rows], SCHEMA)


def as_map(df):
    return {r["day"].day: int(r["amount_raw"]) for r in df.collect()}


def test_fill_last_change_of_day_wins_and_carries(spark):
    df = changes(spark, [(10, ts(1, 8)), (11, ts(1, 20)), (40, ts(4))])
    out = fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-07")
    assert as_map(out) == {1: 11, 2: 11, 3: 11, 4: 40, 5: 40, 6: 40}


def test_no_rows_before_first_change(spark):
    df = changes(spark, [(7, ts(3))])
    out = fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-06")
    assert as_map(out) == {3: 7, 4: 7, 5: 7}


def test_empty_window_gives_no_rows_and_no_error(spark):
    df = changes(spark, [(7, ts(3))])
    assert fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-05", "2021-07-05").count() == 0
    assert fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-05", "2021-07-02").count() == 0


def test_changes_at_or_after_end_are_ignored(spark):
    df = changes(spark, [(7, ts(1)), (9, ts(3, 0))])
    out = fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-03")
    assert as_map(out) == {1: 7, 2: 7}


def test_seed_carries_and_midnight_change_beats_seed(spark):
    stored = spark.createDataFrame(
        [(POOL, TOKEN, Decimal(5), dt.date(2021, 6, 30)), (POOL, TOKEN, Decimal(6), dt.date(2021, 7, 2))],
        "wallet_address binary, token_address binary, amount_raw decimal(38,0), day date")
    new = changes(spark, [(99, dt.datetime(2021, 7, 2, 0, 0))])
    seeds = fill.seed_rows(stored, "2021-07-01", 3)
    log = fill.seeded_changes(new, seeds, "timestamp", "amount_raw")
    out = fill.forward_fill_daily(log, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-04", rank="_src_rank")
    assert as_map(out) == {1: 5, 2: 99, 3: 99}


def test_latest_seed_keeps_all_rows_of_latest_day(spark):
    stored = spark.createDataFrame(
        [(1, dt.date(2021, 7, 1)), (2, dt.date(2021, 7, 3)), (3, dt.date(2021, 7, 3))], "k int, day date")
    got = sorted(r["k"] for r in fill.seed_rows(stored, None, mode="latest").collect())
    assert got == [2, 3]


def test_tie_break_orders_equal_timestamps(spark):
    rows = [(POOL, TOKEN, Decimal(1), ts(1), 2), (POOL, TOKEN, Decimal(2), ts(1), 1)]
    df = spark.createDataFrame(rows, T.StructType(SCHEMA.fields + [T.StructField("tie", T.LongType())]))
    out = fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-02", tie="tie")
    assert as_map(out) == {1: 1}


def test_result_independent_of_partitioning(spark):
    rows = [(v, ts(d, h)) for v, (d, h) in enumerate([(1, 1), (1, 5), (2, 3), (5, 9), (5, 23), (6, 1)])]
    df = changes(spark, rows)
    a = fill.forward_fill_daily(df.repartition(1), KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-09")
    b = fill.forward_fill_daily(df.repartition(7), KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-09")
    assert sorted(a.collect()) == sorted(b.collect())


def test_calendar_left_fill_emits_null_rows_for_uncovered_days(spark):
    iv = spark.createDataFrame([("p", dt.date(2021, 7, 3), dt.date(2021, 7, 5), 10)],
                               "pool string, day date, next_day date, v int")
    out = {r["day"].day: r["pool"] for r in fill.calendar_left_fill(iv, "2021-07-01", "2021-07-07").collect()}
    assert out == {1: None, 2: None, 3: "p", 4: "p", 5: None, 6: None}


def test_no_nested_loop_join_in_fill(spark):
    df = changes(spark, [(1, ts(1))])
    from tests.plan_util import plan_text

    plan = plan_text(fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", "2021-07-01", "2021-07-09"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
