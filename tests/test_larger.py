"""Queries give what their SQL gives on tables that the small ones don't resemble."""

from __future__ import annotations

import os

import duckdb

import __spark_entry__ as entry


def copied(tmp_path, sf, **tables):
    """A folder like sf with some tables replaced: each a list of SELECT statements, one a file."""
    for name in os.listdir(sf):
        if name.removesuffix(".parquet") not in tables:
            (tmp_path / name).symlink_to(f"{sf}/{name}")
    for name, parts in tables.items():
        (tmp_path / f"{name}.parquet").mkdir()
        for k, rows in enumerate(parts):
            duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet/part-{k}.parquet' (FORMAT parquet)")
    return str(tmp_path)


def same_as_sql(spark, at, name):
    con = duckdb.connect()
    for t in (f.removesuffix(".parquet") for f in os.listdir(at)):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{at}/{t}.parquet') else ''}'")
    got, want = entry.queries()[name](spark, at), con.sql(entry.oracle_sql()[name])
    order = [want.columns.index(c) for c in got.columns]
    rows = sorted(map(repr, (tuple(r) for r in got.collect())))
    assert rows and rows == sorted(repr(tuple(r[k] for k in order)) for r in want.fetchall())


def test_more_hits_than_an_answer_holds(spark, sf, tmp_path):
    rows = "SELECT 3 * i + 2 AS conv_id, 0 AS turn, 'user' AS role, 'A station and caution and ' || i AS text FROM range(300) r(i)"
    same_as_sql(spark, copied(tmp_path, sf, conversations=[rows]), "service_search_text")


def test_a_clock_whose_rows_come_in_any_order(spark, sf, tmp_path):
    """More rows of a user than a frame holds, later ones in earlier files; and more files than a batch takes at first."""
    row = "TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, CASE WHEN i % 1000 = 7 THEN NULL ELSE i % 3 END::BIGINT AS user_id, 'view' AS event_type, CASE WHEN i % 11 <> 0 AND i % 1000 <> 7 THEN (hash(i) % 500 + i / 100)::DOUBLE END AS value, '' AS props"
    parts = [f"SELECT i::BIGINT AS event_id, {row} FROM range({a}, {b}) r(i) ORDER BY i DESC" for a, b in [(40000, 80000), (0, 40000), *((80000 + k, 80001 + k) for k in range(110, 0, -1))]]
    same_as_sql(spark, copied(tmp_path, sf, events=parts), "streaming_clock")


def test_brackets_need_no_shuffle(spark, sf, tmp_path):
    """Pages of all kinds, one with more brackets than are judged at once; memory of a task doesn't grow with the table."""
    page = "CASE WHEN i % 50 = 3 THEN NULL WHEN i % 50 = 4 THEN '' WHEN i = 7 THEN repeat('<a>>', 90000) || '<' ELSE (SELECT string_agg(['<', '>', 'x', '😀'][(hash(i * 1000 + k) % 4)::INT + 1], '') FROM range(40) s(k)) END"
    at = copied(tmp_path, sf, pages=[f"SELECT i::BIGINT AS page_id, 'u' AS url, {page} AS html FROM range(400) r(i)"])
    for name in ("orphan_brackets", "bracket_depth"):
        same_as_sql(spark, at, name)
    plan = entry.queries()["orphan_brackets"](spark, at)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
