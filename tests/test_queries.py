"""Every registered query of the library against its SQL in DuckDB, on the smallest tables, or on those that TICKLOOM_DATA names."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TICKLOOM_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return None if x is None else str(x)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(v[i]) for i in order) for v in values], key=lambda r: [(x is None, x or "") for x in r])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sql, name):
    df = entry.queries()[name](spark, DATA)
    want = sql.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
