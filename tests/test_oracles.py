"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lakeloom import plans
from lakeloom.session import TABLES

SMALL = "/root/testdata/sf0.001"
OWN = {n: f for m in plans.modules() for n, f in m.QUERIES.items()}
SQL = {n: s for m in plans.modules() for n, s in m.ORACLES.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return f"{float(x):.8g}"
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(plain, x)) + "]"
    return str(x)


def rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(plain(r[i]) for i in order) for r in tuples)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = OWN[name](spark, SMALL)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(OWN) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert OWN[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "l_returnflag"
    assert set(entry.oracle_sql()) <= set(entry.queries())
