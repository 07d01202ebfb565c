"""Every catalogue query against its SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import math
import os

import pytest

import __spark_entry__ as entry
from fieldspark.plans import catalogue, feeds, model_queries  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, duck, name):
    want = duck.execute(catalogue.SQL[name])
    columns = [d[0] for d in want.description]
    got = catalogue.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(map(plain, r)) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(rows) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
