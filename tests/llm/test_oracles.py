"""The queries that SQL can express, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from curaspan.llm.oracles import ORACLES
from curaspan.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("benchmark", "documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(*columns).collect()))
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(want)


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
