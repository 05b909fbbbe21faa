"""The registered queries equal their DuckDB SQL on sf0.001."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from strata.llm.queries import LLM_ORACLE, LLM_QUERIES
from ..conftest import SF_SMALL


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    df, rel = LLM_QUERIES[name](spark, SF_SMALL), con.sql(LLM_ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in rel.fetchall())
