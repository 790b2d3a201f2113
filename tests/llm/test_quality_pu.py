from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from curaspan.llm import quality_pu
from curaspan.llm.quality_pu import N_FEATURES, keep_good, score_quality, text_features


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = {r["doc_id"]: r for r in score_quality(docs, labels).collect()}
    assert len(found) == docs.count()
    right = []
    for r in found.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    for r in labels.collect():
        if found[r["doc_id"]]["held_out"]:
            right.append(found[r["doc_id"]]["predicted"] == r["quality"])
    assert sum(right) >= 0.9 * len(right)


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id",
        "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality",
    )
    one = {r["doc_id"]: r["score"] for r in score_quality(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in score_quality(docs, turned).collect()}
    assert all(one[i] == pytest.approx(two[i], abs=1e-9) for i in one)


def test_risk_is_learned_without_negatives(monkeypatch):
    rng = np.random.default_rng(0)
    good = rng.random(4000) < 0.8
    x = rng.normal(0, 1, (4000, N_FEATURES))
    x[:, 0] += np.where(good, 2.5, -2.5)
    trusted = good & (rng.random(4000) < 0.3)
    monkeypatch.setattr(quality_pu, "_totals", lambda _, size, add: add(x, trusted))
    model = quality_pu.fit_quality(None, 0.8)
    assert ((model.scores(x) >= 0.5) == good).mean() > 0.97


def test_features_of_odd_texts():
    rows = text_features([b"", b" \n\t ", b"a", ("é" * 100_000).encode(), b"x " * 100_000])
    assert rows.shape == (5, N_FEATURES) and np.isfinite(rows).all() and not rows[0].any()


def test_null_empty_repeated_and_clashing(spark):
    rng = random.Random(0)
    texts = [None, ""] + [" ".join(rng.choices(["a", "b", "cc"], k=30)) for _ in range(10)]
    rows = [(i if i != 1 else None, t, "q") for i, t in enumerate([*texts, texts[-1]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(2, 1), (2, 1), (3, None), (None, 1), (4, 0), (4, 1), (99, 1)], "doc_id long, quality int"
    )
    out = score_quality(docs, labels).collect()
    assert len(out) == 13 and all(0 <= r["score"] <= 1 for r in out)
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [True]
    assert score_quality(docs.limit(0), labels).count() == 0
    assert score_quality(docs, labels.limit(0)).count() == 13
    assert keep_good(docs, labels).columns == docs.columns
