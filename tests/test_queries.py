"""Registered queries against their DuckDB oracles on the smallest driver tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
FAST = ["status_view", "batch_assignment", "row_slice", "insert_ignore", "history_transition", "typed_projection",
        "conform_reject", "file_verdict", "screen_summary", "line_screen", "column_profile", "party_by_role",
        "case_xml", "proceeding_xml", "csv_roundtrip", "refresh_decision", "stream_state"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if v is not None and not isinstance(v, (int, str, bool)):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_files" in df.columns


def test_every_query_has_ops_and_most_have_oracles():
    from feedloom.plans.registry import QUERIES as feed
    q, o = E.queries(), E.oracle_sql()
    assert set(feed) <= set(q) and set(o) <= set(q) and len(set(o) & set(feed)) >= 0.9 * len(feed)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
