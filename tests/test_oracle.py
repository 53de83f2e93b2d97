"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from pagelex.plans.queries import ORACLE, QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(QUERIES)  # of the library itself; optional parts have their own tests


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(repr(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, D)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    assert E.entry(spark).count() > 0
