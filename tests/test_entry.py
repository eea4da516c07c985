"""Every query that has SQL gives what the SQL gives, and all of them run."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from spanloom.plans.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    out = duckdb.connect()
    for t in TABLES:
        out.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return out


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    if name not in ORACLE:
        return
    want = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == sorted(tuple(plain(r[k]) for k in order) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
