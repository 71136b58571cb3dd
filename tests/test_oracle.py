"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, rows_of

from .conftest import SF_SMALL

NO_ORACLE = {"quarantine_files"}

# Queries of the optional training-data subpackage have tests of their own.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_a_reason():
    assert set(NAMES) - set(entry.oracle_sql()) == NO_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    if name in NO_ORACLE:
        assert got
        return
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["event_type", "total_events"] and df.count() > 0
