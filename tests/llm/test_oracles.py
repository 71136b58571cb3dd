"""The registered queries that SQL can express, against DuckDB; all queries on empty tables."""

from __future__ import annotations

import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES

from .helpers import SF_TINY, tables


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_TINY)
    columns = sorted(got.columns)
    want = tables(SF_TINY).execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_empty_tables(spark, tmp_path, name):
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        spark.read.parquet(f"{SF_TINY}/{table}.parquet").filter("false").write.parquet(f"{tmp_path}/{table}.parquet")
    got = QUERIES[name](spark, str(tmp_path))
    assert got.columns and got.collect() == []
