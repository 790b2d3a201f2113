"""Every query of the curation engine against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from conftest import plan_of
from curaspan.plans.catalog import QUERIES as CATALOG

duckdb = pytest.importorskip("duckdb")

QUERIES = {name: query for name, query in contract.queries().items() if name in CATALOG}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CATALOG) <= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert costly not in plan
    got = comparable(df.columns, df.collect())
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == comparable(columns, result.fetchall())


def test_entry(spark, sf_dir):
    df = contract.entry(spark)
    assert df.columns == ["record_id", "pii_type", "matched_text", "span_start", "span_end", "confidence", "layer"]
    assert df.count() > 0
