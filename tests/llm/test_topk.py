from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from curaspan.llm import topk
from curaspan.llm.topk import top_inner_products


def plain(rows, modulus, k=10):
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for q, a in usable:
        if q % modulus == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return {q: v for q, v in out.items() if v}


def result(df, modulus, k=10):
    out = {}
    for r in top_inner_products(df, F.col("vec_id") % modulus == 0, k=k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("shard", [4096, 60])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_VECTORS", shard)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 20)
    rng = random.Random(shard)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 600)]  # many equal vectors
    rows += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 8), (None, [1.0] * 8)]
    rows += [(610, [float("inf")] * 8), (620, [0.0] * 8), (700, [3.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df.withColumn("score", F.lit(1)), 10) == plain(rows, 10)


def test_few_repeated_ragged_huge_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [2.0]), (1, [2.0]), (2, []), (3, [1e12, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = result(df, 100)
    q = [1024, 2048]
    assert found == {
        0: [
            (1, 3, q[0] * math.floor(1024 * 1e12) + q[1] * 1024),
            (2, 1, q[0] * 2048),
            (3, 1, q[0] * 2048),
            (4, 2, 0),
        ]
    }
    assert result(df.limit(0), 100) == {}
    assert result(df.where("vec_id = 0"), 100) == {}
