"""Every registered query against its DuckDB oracle: same rows, same values.

Runs on sf0.001 (all queries) — the driver repeats this at sf0.01.
"""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from helpers import canonical
from pipewright.plans.registry import QUERIES
from pipewright.sources import DRIVER_TABLES

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_cols) == len(set(s_cols))
    assert canonical(s_cols, s_rows) == canonical(o_cols, o_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "cac" in df.columns
