"""Every query against its SQL on the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = table(df.columns, df.collect())
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["location_name", "latitude", "longitude", "timestamp"]
