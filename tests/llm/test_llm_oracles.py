"""The operators' queries against their DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

from visitflow.llm.oracles import ORACLES
from visitflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
