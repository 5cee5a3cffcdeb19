"""Plan shape: no nested-loop or cartesian joins, filters reach the scan,
the daily compaction aggregates map-side in a hash aggregate."""

import pytest

import __spark_entry__ as E
from tests.plan_util import plan_text

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["job_pair", "daily_forward_fill", "classify_index", "value_with_fallback",
                                  "job_deltas", "job_flows", "calendar_left_fill", "seeded_refresh", "chain_pool_labels"])
def test_no_nested_loop_or_cartesian(spark, name):
    plan = plan_text(E.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_time_window_reaches_the_scan(spark):
    plan = plan_text(E.queries()["job_pair"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan
    assert "LessThan(ts,2024-02-01T00:00)" in plan


def test_compaction_is_partial_hash_aggregate(spark):
    plan = plan_text(E.queries()["daily_forward_fill"](spark, SF), "simple")
    assert "partial_max_by" in plan
    assert "SortAggregate" not in plan


def test_window_bounds_push_down_on_zoned_timestamps(spark, scratch):
    import datetime as dt
    import os

    from poolbook.operators import fill

    path = os.path.join(scratch, "ltz.parquet")
    spark.createDataFrame([(1, dt.datetime(2021, 7, 1))], "k int, ts timestamp").write.parquet(path)
    plan = plan_text(fill.in_window(spark.read.parquet(path), "ts", "2021-07-01", "2021-07-02"))
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


@pytest.mark.parametrize("job", ["PAIR_JOB", "CURVE_JOB"])
def test_building_a_window_runs_no_job(spark, job):
    """The sources are opened first (reading a Parquet footer is a job)."""
    from dataclasses import replace

    from poolbook.plans import catalog as C
    from poolbook.plans import jobs as J

    src = C._pair_sources(spark, SF)
    opened = {n: getattr(src, n)() for n in ("balances", "registry", "tokens", "prices", "labels", "trades")
              if getattr(src, n) is not None}
    if job == "CURVE_JOB":
        opened["registry"] = C.pools.pair_union_distinct(opened["registry"], "pair", "token0", "token1")
    src = replace(src, **{n: (lambda df=df: df) for n, df in opened.items()})
    spark.sparkContext.setJobGroup("plan-only", "window build")
    try:
        out = J.build_window(getattr(C, job), src, "2024-01-01", "2024-01-05")
        assert out.columns == J.LIQUIDITY_COLUMNS
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
