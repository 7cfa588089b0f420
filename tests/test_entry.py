"""Every registered query that has SQL gives the rows of that SQL."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from eventlake import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return str(v) if isinstance(v, (datetime.date, bool)) else v


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    expected = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str) == expected


def test_queries_and_sql_agree_on_names():
    assert set(oracle.sql()) == set(catalog.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
