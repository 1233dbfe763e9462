"""Every registered query against its DuckDB oracle (sf0.001 fixture)."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import SMALL

from visitflow.oracles import oracle_sql
from visitflow.plans.catalog import QUERIES


def queries():
    """The library's own queries; those of the optional subpackage have their tests with it."""
    return QUERIES


TABLES = ["events"]

# Spark simple type -> DuckDB type name.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if v is not None and hasattr(v, "isoformat"):
        return v.isoformat()
    return None if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    sql = oracle_sql().get(name)
    df = queries()[name](spark, SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        pytest.skip("no oracle")
    rel = duck.sql(sql)
    o_cols, o_rows = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: TYPE_NAMES.get(t, t) for c, t in df.dtypes} == duck_types
    assert len(s_rows) == len(o_rows)
    assert _rows(df.columns, s_rows) == _rows(o_cols, o_rows)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["total_patients"] > 0
