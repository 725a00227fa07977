"""Every registered query against its SQL counterpart, and the shape of the plans."""

import datetime

import duckdb
import pytest

import __spark_entry__ as driver
from wireloom.plans.oracles import oracle_sql
from wireloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def in_order(rows, names, wanted):
    places = [names.index(n) for n in wanted]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    return sorted((tuple(row[i] for i in places) for row in rows), key=key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = in_order(result.fetchall(), columns, sorted(columns))
    got = in_order([tuple(r) for r in df.collect()], df.columns, sorted(columns))
    assert got == expected and got
    assert not any(isinstance(v, datetime.datetime) for v in got[0])


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == [
        "request_key", "server", "http_status", "start_ms", "end_ms", "duration_ms",
    ]
    assert df.count() == 700
