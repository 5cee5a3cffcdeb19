"""Scans over uneven keys, against plain Python; exact medians of hot groups."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from poolbook.operators import quantile, scan
from tests.plan_util import plan_text

LOG = "key string, ts timestamp_ntz, tie bigint, delta decimal(20,2)"
T0 = dt.datetime(2024, 1, 1)


def hot_log(n=6000, seed=1):
    """A third of all rows in one key and one day; ties, NULL keys, NULL deltas."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        key = "hot" if hot else rnd.choice([None, "hot", *"abcdef"])
        ts = T0 + (dt.timedelta(seconds=rnd.randrange(2000)) if hot else dt.timedelta(hours=rnd.randrange(900)))
        rows.append((key, ts, i, None if rnd.random() < 0.1 else Decimal(rnd.randrange(-500, 500)) / 4))
    return rows


def running(rows, frame):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            seen = mine[: i + 1] if frame == "rows" else [s for s in mine if s[1] <= r[1]]
            values = [s[3] for s in seen if s[3] is not None]
            out[r[2]] = sum(values) if values else None
    return out


@pytest.mark.parametrize("frame", ["rows", "range"])
def test_running_sum_of_a_hot_key(spark, frame):
    rows = hot_log(1500)
    out = scan.running_sum(spark.createDataFrame(rows, LOG), ["key"], "ts", "delta", frame, "tie")
    assert out.columns == ["key", "ts", "tie", "delta", "amount_raw"]
    assert {r["tie"]: r["amount_raw"] for r in out.collect()} == running(rows, frame)
    empty = scan.running_sum(spark.createDataFrame([], LOG), ["key"], "ts", "delta", frame, "tie")
    assert empty.count() == 0


def test_no_task_of_the_local_pass_has_twice_the_median(spark):
    rows = spark.createDataFrame(hot_log(24_000), LOG)
    order = [F.col("ts"), F.col("tie")]
    dealt = scan._dealt(scan.ranged(rows, ["key"], order), None)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * statistics.median(sizes)
    per_range = [r["count"] for r in scan.ranged(rows, ["key"], order).groupBy(scan.RANGE).count().collect()]
    assert max(per_range) <= 2 * statistics.median(per_range)


def test_the_local_pass_adds_no_exchange_and_no_row_join(spark):
    out = scan.running_sum(spark.createDataFrame(hot_log(300), LOG), ["key"], "ts", "delta", "rows", "tie")
    plan = plan_text(out, "simple")
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and plan.count("BroadcastHashJoin") == 1
    # ranges dealt to tasks, totals per (range, key), their scan: three, and none for the window over rows
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") <= 2


def test_asof_equals_a_search_per_row(spark):
    rnd = random.Random(7)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    prices = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, day(rnd.randrange(40))]), rnd.choice([None, float(rnd.randrange(9))])) for _ in range(60)]
    asks = [(i, rnd.choice([None, "a", "a", "a", "b", "x"]), rnd.choice([None, *map(day, range(45))])) for i in range(900)]
    left = spark.createDataFrame(asks, "id int, token string, day date")
    right = spark.createDataFrame(prices, "t string, since date, price double")
    out = scan.asof_join(left, right, {"token": "t"}, "day", "since", ["price"])
    assert out.columns == ["id", "token", "day", "price"]

    def search(token, at):
        best = None
        for t, since, price in prices:
            if t is not None and since is not None and token == t and at is not None and since <= at:
                if best is None or (since, price is not None, price or 0) > best[:3]:
                    best = (since, price is not None, price or 0, price)
        return best and best[3]

    assert {r["id"]: r["price"] for r in out.collect()} == {i: search(t, d) for i, t, d in asks}
    assert scan.asof_join(left, right.limit(0), {"token": "t"}, "day", "since", ["price"]).where("price is not null").count() == 0
    plan = plan_text(out.select("*"), "simple")
    # one window over the rows, one over the ranges (a row each per key)
    assert plan.count("Window [last") == 2 and "Generate" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("make", [
    lambda r: r.random(), lambda r: 2.0 ** r.randrange(-300, 300), lambda r: float(r.randrange(3)), lambda r: 1.0,
    lambda r: r.choice([0.0, 1e9]) + r.random() * 1e-3])
def test_exact_percentile_of_hot_groups(spark, make, monkeypatch):
    monkeypatch.setattr(quantile, "CELLS", 4)
    rnd = random.Random(3)
    rows = [("one", make(rnd)) for _ in range(2001)] + [(None, make(rnd)) for _ in range(400)]
    rows += [(g, make(rnd)) for g in "abc" for _ in range(rnd.randrange(1, 30))] + [("a", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    for p in (0.5, 0.01):
        got = {r["g"]: r["v"] for r in quantile.exact_percentile(df, ["g"], "v", p, limit=50).collect()}
        want = {r["g"]: r["v"] for r in df.groupBy("g").agg(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias("v")).collect()}
        assert got == want
    assert quantile.exact_percentile(df.limit(0), ["g"], "v").count() == 0
