"""Backfill by windows + refresh (C3) through insert-ignore on Parquet."""

import datetime as dt
import os

import pytest

from poolbook.operators import balance
from poolbook.plans import catalog as C
from poolbook.plans import jobs as J
from poolbook.sources import standins as S
from poolbook.streaming import polling as R
from tests.plan_util import plan_text

SF = "/root/testdata/sf0.001"


def _job(spark):
    src = C._pair_sources(spark, SF)
    return lambda start, end, stored: J.build_window(C.PAIR_JOB, src, start, end, stored=stored)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_chained_windows_equal_full_run_and_rerun_adds_nothing(spark, scratch):
    job = _job(spark)
    schema = J.build_window(C.PAIR_JOB, C._pair_sources(spark, SF), "2024-01-01", "2024-01-02").schema
    table = R.liquidity_table(os.path.join(scratch, "liquidity"), schema, "Uniswap", "2")
    windows = [("2024-01-11", "2024-02-01"), ("2024-01-01", "2024-01-11")]  # given out of order
    counts = R.backfill(spark, job, table, windows)
    full = J.build_window(C.PAIR_JOB, C._pair_sources(spark, SF), "2024-01-01", "2024-02-01")
    stored = R.stored_table(spark, table)
    assert sum(counts) == full.count()
    assert _rows(stored, J.LIQUIDITY_COLUMNS) == _rows(full, J.LIQUIDITY_COLUMNS)
    assert R.backfill(spark, job, table, windows) == [0, 0]
    # no late data: a refresh recomputes the overlap and writes nothing new
    assert R.refresh(spark, job, table, dt.datetime(2024, 2, 1, 0, 30)) == 0
    assert {r["month"] for r in stored.select("month").distinct().collect()} == {"2024-01"}


def test_window_after_a_gap_is_refused(spark, scratch):
    job = _job(spark)
    schema = J.build_window(C.PAIR_JOB, C._pair_sources(spark, SF), "2024-01-01", "2024-01-02").schema
    table = R.liquidity_table(os.path.join(scratch, "liquidity"), schema, "Uniswap", "2")
    R.backfill(spark, job, table, [("2024-01-01", "2024-01-05")])
    try:
        R.backfill(spark, job, table, [("2024-01-10", "2024-01-12")])
    except ValueError as exc:
        assert "gap" in str(exc)
    else:
        raise AssertionError("a window after a gap must be refused")


def test_flow_table_backfill_writes_each_key_once(spark, scratch):
    def flows_job(start, end, stored):
        v1 = balance.net_flows(S.event_transfers(spark, SF), S.members(spark, SF), start, end)
        v2 = balance.vault_deltas(start, end, swaps=S.event_vault_swaps(spark, SF)).withColumnRenamed("delta_amount", "amount")
        return J.build_flows_window(v1, v2, S.tokens(spark), S.prices(spark, SF), S.hourly(spark, SF),
                                    S.pool_weights(spark, SF), start, end, 2, stored=stored)

    schema = flows_job("2024-01-01", "2024-01-02", None).schema
    table = R.view_liquidity_table(os.path.join(scratch, "view_liquidity"), schema)
    counts = R.backfill(spark, flows_job, table, [("2024-01-01", "2024-01-16"), ("2024-01-16", "2024-02-01")])
    stored = R.stored_table(spark, table)
    assert sum(counts) == stored.count() > 0
    assert stored.groupBy(*J.VIEW_LIQUIDITY_COLUMNS[:3]).count().where("count > 1").count() == 0
    assert R.backfill(spark, flows_job, table, [("2024-01-16", "2024-02-01")]) == [0]


def test_compaction_keeps_rows_and_reduces_files(spark, scratch):
    import glob

    job = _job(spark)
    schema = J.build_window(C.PAIR_JOB, C._pair_sources(spark, SF), "2024-01-01", "2024-01-02").schema
    table = R.liquidity_table(os.path.join(scratch, "liquidity"), schema, "Uniswap", "2")
    R.backfill(spark, job, table, [("2024-01-01", "2024-01-05"), ("2024-01-05", "2024-01-09"),
                                   ("2024-01-09", "2024-01-13")])
    before = _rows(R.stored_table(spark, table), J.LIQUIDITY_COLUMNS)
    files = lambda: glob.glob(os.path.join(table.path, "project=Uniswap", "version=2", "month=2024-01", "*.parquet"))
    n_before = len(files())
    assert R.compact(spark, table, ["2024-01"]) == len(before)
    assert _rows(R.stored_table(spark, table), J.LIQUIDITY_COLUMNS) == before
    assert len(files()) == 1 < n_before


def test_refresh_on_arrival_matches_batch_build(spark, scratch):
    """New change files arrive in two drops; each availableNow run writes the
    affected days; the table ends equal to one batch build."""
    import datetime as dt
    from decimal import Decimal

    from pyspark.sql import types as T

    from poolbook.plans.config import PoolJob
    from poolbook.plans.jobs import Sources
    from poolbook.streaming import refresh_on_arrival

    schema = T.StructType([T.StructField("wallet_address", T.LongType()), T.StructField("token_address", T.StringType()),
                           T.StructField("amount_raw", T.DecimalType(38, 0)), T.StructField("timestamp", T.TimestampNTZType())])
    changes_dir = os.path.join(scratch, "changes")
    drop = lambda rows, part: spark.createDataFrame(rows, schema).write.mode("append").parquet(changes_dir)
    drop([(1, "A", Decimal(10), dt.datetime(2024, 1, 1, 5)), (2, "A", Decimal(7), dt.datetime(2024, 1, 2, 5))], "p1")
    registry = spark.createDataFrame([(1, "A"), (2, "A")], "exchange long, token string")
    tokens = spark.createDataFrame([("A", "AAA", 0)], "contract_address string, symbol string, decimals int")
    prices = spark.createDataFrame([], "contract_address string, minute timestamp_ntz, price double")
    job_cfg = PoolJob("Test", "1", "single", pool_col="exchange", constant_index="token_0")
    src = Sources(balances=lambda: spark.read.schema(schema).parquet(changes_dir), registry=lambda: registry,
                  tokens=lambda: tokens, prices=lambda: prices)
    job = lambda s, e, stored: J.build_window(job_cfg, src, s, e, stored=stored)
    table = R.liquidity_table(os.path.join(scratch, "fact"), job("2024-01-01", "2024-01-02", None).schema, "Test", "1")
    clock = {"now": dt.datetime(2024, 1, 4, 1)}
    run = lambda: refresh_on_arrival(spark, job, table, changes_dir, schema, name=f"t{id(table)}",
                                     now=lambda: clock["now"]).awaitTermination()
    with pytest.raises(ValueError, match="run a backfill first"):
        run()
    assert R.backfill(spark, job, table, [("2024-01-01", "2024-01-02")]) == [1]
    run()
    first = R.stored_table(spark, table).count()
    assert first == 3 + 2  # wallet 1: Jan 1-3, wallet 2: Jan 2-3
    drop([(1, "A", Decimal(11), dt.datetime(2024, 1, 5, 5))], "p2")
    clock["now"] = dt.datetime(2024, 1, 7, 1)
    run()
    full = J.build_window(job_cfg, src, "2024-01-01", "2024-01-07")
    assert _rows(R.stored_table(spark, table), J.LIQUIDITY_COLUMNS) == _rows(full, J.LIQUIDITY_COLUMNS)


def test_stored_table_is_read_by_month(spark, scratch, monkeypatch):
    """Seeds, opening balance, mark and guard carry a partition filter."""
    from poolbook import schemas
    from poolbook.operators import fill, sink

    table = R.liquidity_table(os.path.join(scratch, "fact"), schemas.LIQUIDITY, "P", "1")
    row = [dt.date(2021, 3, 15), "S", 1.0, "N", "P", "1", "DEX", 5, 2.0, b"t", b"p", "token_0", 0.5]
    rows = [[d, *row[1:]] for d in (dt.date(2021, 3, 15), dt.date(2021, 5, 30), dt.date(2021, 5, 31))]
    from decimal import Decimal

    R.write_window(spark.createDataFrame([[*r[:7], Decimal(r[7]), *r[8:]] for r in rows], schemas.LIQUIDITY), table,
                   R.stored_table(spark, table), "2021-03-01", "2021-06-01")
    stored = R.stored_table(spark, table)
    for frame in (fill.seed_rows(stored, "2021-06-01"), balance.opening_balance(stored, "2021-06-01", time_col="day")):
        filters = [line for line in plan_text(frame).splitlines() if line.startswith("PartitionFilters")]
        assert filters and all("month" in line for line in filters)
    assert balance.opening_balance(stored, "2021-06-01", time_col="day").count() == 1
    probed = []
    for name in ("high_water_mark", "window_filled"):
        monkeypatch.setattr(sink, name, lambda t, *a, _f=getattr(sink, name), **k: (probed.append(plan_text(t)), _f(t, *a, **k))[1])
    assert R.latest_day(stored, table, "2021-06-02") == dt.date(2021, 5, 31)
    assert R.latest_day(stored, table, "2021-05-30") == dt.date(2021, 3, 15)   # nothing near: older months
    assert R.latest_day(stored, table, "2021-03-15") is None
    assert R.window_filled(stored, table, "2021-05-01", "2021-06-01")
    assert not R.window_filled(stored, table, "2021-04-01", "2021-05-01")
    assert probed and all("month" in line for plan in probed for line in plan.splitlines()
                          if line.startswith("PartitionFilters"))
