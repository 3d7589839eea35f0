"""Every query with SQL gives what DuckDB gives on the same tables; every other one runs."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from archiva.catalog import QUERIES, SQL

HEAVY = {"q_pipeline"}  # tested by itself


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return int(v) if type(v).__name__ == "Decimal" and v % 1 == 0 else float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*(f"`{c}`" for c in cols)).collect()), key=repr)
    if name in SQL:
        r = duck.execute(SQL[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)
        assert got == want


def test_entry(spark):
    assert entry.entry(spark).columns == ["persona_a", "persona_b", "peso"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
