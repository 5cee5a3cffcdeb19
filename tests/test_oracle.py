"""Every registered query against its DuckDB formulation on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from poolbook.plans.catalog import ORACLE, QUERIES
from poolbook.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (decimal.Decimal, float, int)) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def _duck_type(t) -> str:
    from pyspark.sql import types as T

    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
              T.StringType: "VARCHAR", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
              T.BooleanType: "BOOLEAN", T.BinaryType: "BLOB"}
    for k, v in simple.items():
        if isinstance(t, k):
            return v
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, T.ArrayType):
        return _duck_type(t.elementType) + "[]"
    return t.simpleString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SF), duck, ORACLE[name])


def assert_same(df, duck, sql):
    cols = sorted(df.columns)
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: _duck_type(f.dataType) for f in df.schema.fields} == duck_types
    mine = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    theirs = sorted((tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert mine == theirs


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:3] == ["day", "token_symbol", "token_amount"]
