"""Spark operators against plain-Python brute force on random, skewed logs:
one hot key holds most rows, many changes share a day, some share an instant."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from poolbook.operators import balance, fill

DAY0 = dt.datetime(2021, 7, 1)
KEYS = ["wallet_address", "token_address"]

event = st.tuples(
    st.sampled_from(["hot"] * 6 + ["a", "b"]),         # skew: 3/4 of rows on one key
    st.sampled_from(["t"] * 3 + ["u"]),
    st.integers(-10**20, 10**20),
    st.integers(0, 6 * 24 - 1),                        # hour over six days
    st.sampled_from([0, 0, 30]),                       # minute: many equal instants
)
events = st.lists(event, min_size=1, max_size=60)


def _frame(spark, rows):
    data = [(w, t, Decimal(v), DAY0 + dt.timedelta(hours=h, minutes=m), i) for i, (w, t, v, h, m) in enumerate(rows)]
    return spark.createDataFrame(
        data, "wallet_address string, token_address string, amount_raw decimal(38,0), timestamp timestamp_ntz, tie long")


def brute_fill(rows, start: dt.date, end: dt.date):
    out = {}
    keyed = {}
    for i, (w, t, v, h, m) in enumerate(rows):
        keyed.setdefault((w, t), []).append((DAY0 + dt.timedelta(hours=h, minutes=m), i, v))
    for key, changes in keyed.items():
        changes.sort()
        d = start
        while d < end:
            cutoff = dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
            known = [v for ts, i, v in changes if ts < cutoff and ts >= dt.datetime.combine(start, dt.time())]
            if known:
                out[(d, *key)] = known[-1]
            d += dt.timedelta(days=1)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=events, first=st.integers(1, 3), span=st.integers(1, 7))
def test_forward_fill_matches_brute_force(spark, rows, first, span):
    start = dt.date(2021, 7, first)
    end = start + dt.timedelta(days=span)
    df = fill.in_window(_frame(spark, rows), "timestamp", start, end)
    got = {(r["day"], r["wallet_address"], r["token_address"]): int(r["amount_raw"])
           for r in fill.forward_fill_daily(df, KEYS, "amount_raw", "timestamp", start, end, tie="tie").collect()}
    assert got == brute_fill(rows, start, end)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=events)
def test_running_balances_match_brute_force(spark, rows):
    df = _frame(spark, rows).withColumnRenamed("amount_raw", "delta")
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1], rows[i][3], rows[i][4], i))
    rows_total, range_total, acc = {}, {}, {}
    for i in order:
        key = rows[i][:2]
        acc[key] = acc.get(key, 0) + rows[i][2]
        rows_total[i] = acc[key]
    for i in order:
        key, instant = rows[i][:2], rows[i][3:5]
        range_total[i] = sum(rows[j][2] for j in range(len(rows))
                             if rows[j][:2] == key and rows[j][3:5] <= instant)
    for frame, want in (("rows", rows_total), ("range", range_total)):
        out = balance.running_balance_events(df, KEYS, "timestamp", "delta", frame=frame, tie="tie")
        assert {r["tie"]: int(r["amount_raw"]) for r in out.collect()} == want


key_part = st.one_of(st.none(), st.sampled_from(["a", "b", "hot", "hot", "hot"]))
batch_rows = st.lists(st.tuples(st.sampled_from([1, 2, 2, 2]), key_part, st.integers(0, 5), st.integers(0, 99)),
                      min_size=1, max_size=40)
target_keys = st.lists(st.tuples(st.sampled_from([1, 2, 3]), key_part), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=batch_rows, stored=target_keys)
def test_insert_ignore_matches_brute_force(spark, rows, stored):
    from poolbook.operators import sink

    batch = spark.createDataFrame(rows, "k int, t string, o int, v int")
    target = spark.createDataFrame(stored, "k int, t string")
    got = sorted((tuple(r) for r in sink.new_rows(batch, target, ["k", "t"], ["o", "v"]).collect()), key=repr)
    # brute force: NULL keys never collide; otherwise the smallest (o, v) per
    # key wins, unless the key is already stored (NULL stored keys match nothing)
    stored_keys = {s for s in stored if None not in s}
    best = {}
    for k, t, o, v in rows:
        if t is None:
            continue
        if (k, t) not in best or (o, v) < best[(k, t)][2:]:
            best[(k, t)] = (k, t, o, v)
    want = [r for key, r in best.items() if key not in stored_keys] + [r for r in rows if r[1] is None]
    assert got == sorted(want, key=repr)
