"""Each query against its SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(sf):
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    return con


def plain(v):
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.6f}"
    return f"{float(v):.6f}" if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, sf, tables, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    found = tables.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    mine = sorted(tuple(plain(r[c]) for c in order) for r in got)
    theirs = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert [tuple(map(str, r)) for r in mine] == [tuple(map(str, r)) for r in theirs]


def test_entry_and_registries(spark):
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["year", "x_tile", "y_tile"]
