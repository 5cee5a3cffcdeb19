"""File layout by a space-filling curve, and the calendar join in one read."""

import datetime as dt
import os
import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from poolbook import schemas
from poolbook.operators import fill, layout
from poolbook.streaming import polling
from tests.plan_util import plan_text


def opened(folder, column, value):
    """(files whose min/max statistics admit the value, all files)."""
    hit = total = 0
    for file in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        total += 1
        hit += any(s.min <= value <= s.max for s in stats)
    return hit, total


def test_filters_on_pool_and_token_each_skip_most_files(spark, scratch):
    rnd = random.Random(9)
    address = lambda: bytes(rnd.randrange(256) for _ in range(20))
    pools, tokens = [address() for _ in range(60)], [address() for _ in range(40)]
    days = [dt.date(2021, 7, d) for d in range(1, 31)]
    rows = [(d, p, t, "Uniswap", "2") for p in pools for t in rnd.sample(tokens, 8) for d in days]
    df = spark.createDataFrame(rows, "day date, pool_address binary, token_address binary, project string, version string")
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.LIQUIDITY.fields])
    table = polling.liquidity_table(os.path.join(scratch, "t"), schemas.LIQUIDITY, "Uniswap", "2")
    for start, end in (("2021-07-01", "2021-07-16"), ("2021-07-16", "2021-08-01")):
        part = full.where((F.col("day") >= start) & (F.col("day") < end))
        polling.write_window(part, table, polling.stored_table(spark, table), start, end)
    keys = ["day", "pool_address", "token_address"]
    before = sorted(map(tuple, polling.stored_table(spark, table).select(*keys).collect()))
    assert polling.compact(spark, table, ["2021-07", "2021-08"], files_per_month=64) == len(rows)
    assert sorted(map(tuple, polling.stored_table(spark, table).select(*keys).collect())) == before
    # the day, which the month folder narrows already, has the lowest bits of the curve
    for column, value, share in (("pool_address", pools[7], 0.4), ("token_address", tokens[5], 0.4), ("day", days[11], 0.6)):
        hit, total = opened(table.path, column, value)
        assert total >= 48 and hit <= total * share, (column, hit, total)
    # sized by bytes: everything fits one file
    assert polling.compact(spark, table, ["2021-07"]) == len(rows)
    assert opened(table.path, "day", days[0])[1] == 1
    assert layout.files_for(spark, [table.path], 1000) > 10


def test_calendar_join_reads_its_source_once(spark, scratch):
    rows = [("a", dt.date(2021, 1, 5), dt.date(2021, 1, 5)), ("b", dt.date(2020, 12, 1), dt.date(2021, 1, 3)),
            ("c", dt.date(2021, 3, 7), dt.date(2021, 4, 1)), (None, dt.date(2021, 1, 10), dt.date(2021, 1, 12)), ("d", None, None)]
    spark.createDataFrame(rows, "k string, day date, next_day date").write.parquet(os.path.join(scratch, "i"))
    start, end = dt.date(2021, 1, 1), dt.date(2021, 3, 20)  # two numbers of the bitmap
    out = fill.calendar_left_fill(spark.read.parquet(os.path.join(scratch, "i")), start, end)
    plan = plan_text(out, "simple")
    assert plan.count("Scan ExistingRDD") == 1 and "FileScan" not in plan and "Join" not in plan
    want = []
    for n in range((end - start).days):
        day = start + dt.timedelta(days=n)
        hits = [(day, k) for k, a, b in rows if a is not None and a <= day < b]
        want += hits or [(day, None)]
    assert sorted((r["day"], r["k"] or "") for r in out.collect()) == sorted((d, k or "") for d, k in want)
    assert fill.calendar_left_fill(spark.read.parquet(os.path.join(scratch, "i")), end, start).count() == 0
