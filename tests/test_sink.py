"""Insert-ignore (K1): first write wins, reruns add nothing, NULL keys."""

import os

from pyspark.sql import functions as F

from poolbook.operators import sink


def test_first_row_per_key_by_order_and_existing_keys_skipped(spark):
    batch = spark.createDataFrame(
        [(1, "a", 3, "x"), (1, "a", 1, "y"), (2, "b", 5, "z"), (3, "c", 1, "w")], "k int, t string, o int, v string")
    target = spark.createDataFrame([(3, "c")], "k int, t string")
    got = sorted(tuple(r) for r in sink.new_rows(batch, target, ["k", "t"], ["o"]).collect())
    assert got == [(1, "a", 1, "y"), (2, "b", 5, "z")]


def test_null_key_rows_are_never_duplicates(spark):
    batch = spark.createDataFrame([(1, None, 1), (1, None, 2)], "k int, t string, o int")
    target = spark.createDataFrame([(1, None)], "k int, t string")
    assert sink.new_rows(batch, target, ["k", "t"], ["o"]).count() == 2


def test_insert_ignore_writes_once_and_rerun_inserts_zero(spark, scratch):
    path = os.path.join(scratch, "fact")
    batch = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "b", 30)], "k int, t string, v int")
    empty = spark.createDataFrame([], "k int, t string")
    assert sink.insert_ignore(batch, path, empty, ["k", "t"], ["v"]) == 2
    stored = spark.read.parquet(path)
    changed = spark.createDataFrame([(1, "a", 99), (3, "c", 1)], "k int, t string, v int")
    assert sink.insert_ignore(changed, path, stored, ["k", "t"], ["v"]) == 1
    stored = spark.read.parquet(path)
    assert sink.insert_ignore(changed, path, stored, ["k", "t"], ["v"]) == 0
    rows = {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert rows == {(1, 10), (2, 20), (3, 1)}  # first write wins for key 1


def test_window_probes(spark):
    import datetime as dt

    t = spark.createDataFrame([("P", "1", dt.date(2021, 1, 5))], "project string, version string, day date")
    assert sink.high_water_mark(t, "P", "1") == dt.date(2021, 1, 5)
    assert sink.high_water_mark(t, "Q", "1") is None
    assert sink.window_filled(t, "2021-01-01", "2021-01-06", "P", "1")
    assert not sink.window_filled(t, "2021-01-06", "2021-01-10", "P", "1")


def test_first_per_key_keeps_null_keys_apart(spark):
    batch = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (None, "a", 5), (None, "a", 6)], "k int, t string, o int")
    got = sorted((tuple(r) for r in sink.first_per_key(batch, ["k", "t"], ["o"]).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (None, "a", 5), (None, "a", 6)], key=repr)


def test_equal_rows_with_a_null_key_all_stay(spark):
    batch = spark.createDataFrame([(None, "a", 5), (None, "a", 5), (1, None, 5), (2, "b", 1), (2, "b", 1)],
                                  "k int, t string, o int")
    got = sorted((tuple(r) for r in sink.first_per_key(batch, ["k", "t"], ["o"]).collect()), key=repr)
    assert got == sorted([(None, "a", 5), (None, "a", 5), (1, None, 5), (2, "b", 1)], key=repr)
    assert sink.first_per_key(batch.select("k", "t"), ["k", "t"], []).count() == 4


def test_batch_is_scanned_once_and_order_ties_are_settled(spark, scratch):
    from tests.plan_util import plan_text

    path = os.path.join(scratch, "batch")
    spark.createDataFrame([(1, 7, "b"), (1, 7, "a"), (None, 7, "c")], "k int, o int, v string").write.parquet(path)
    target = spark.createDataFrame([(9,)], "k int")
    rows = sink.new_rows(spark.read.parquet(path), target, ["k"], ["o"])
    assert plan_text(rows, "simple").count("FileScan") == 1
    assert {tuple(r) for r in rows.collect()} == {(1, 7, "a"), (None, 7, "c")}
