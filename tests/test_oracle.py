"""Every registered query with an oracle matches DuckDB on sf0.001
(row count, column names, multiset of rounded rows)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from scoutlab.sources.io import TEST_TABLES

from conftest import SF_SMALL


LLM = set(E.LLM_ORACLE)  # these have their own tests


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - LLM))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["ClubName", "LeagueName", "Country"]
    assert df.count() == 25


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
