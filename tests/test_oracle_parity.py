"""Every registered query equals its DuckDB oracle on sf0.001 (rows,
column names and the multiset of values)."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from strata.queries import ORACLE, QUERIES
from strata.sources.testdata import TABLES

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Region_id", "n_records", "total_motor_vehicles", "avg_intensity", "total_link_km"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    rel = con.sql(ORACLE[name])
    assert cols == sorted(rel.columns)
    s_rows = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    idx = [rel.columns.index(c) for c in cols]
    o_rows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert sum(s_rows.values()) == sum(o_rows.values())
    assert s_rows == o_rows
