"""Every query with an SQL counterpart is compared with DuckDB on the smallest data; all names are sound."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__

DATA = os.environ.get("LODESTONE_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
        return "null"
    if isinstance(v, float):  # a column of whole numbers with nulls comes as floats from one engine
        return str(int(v)) if v.is_integer() else repr(round(float(v), 6))
    return str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(cell(v) for v in r) for r in frame[names].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(ORACLES[name]).df())


def test_names():
    assert set(ORACLES) <= set(QUERIES)
