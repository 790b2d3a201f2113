from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from curaspan.llm import ranked
from curaspan.llm.ranked import Shard, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, k=10):
    """(item, rank, doc, score) of every item by scoring all documents."""
    own = [(i, terms(t)) for i, t in docs]
    own = [(i, t) for i, t in own if t]
    n_docs, length = len(own), sum(len(t) for _, t in own)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for doc, words in own:
            m = 100 - 90 + (90 * len(words) * n_docs) // length
            score = 0
            for t in query & set(words):
                df = sum(t in w for _, w in own)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                tf = words.count(t)
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = ["a", "B", "é", "日本", "x1", "the", "THE", "of", "42", "z"] + [f"w{i}" for i in range(30)]
    docs = []
    for i in range(60):
        n = rng.choice([0, 1, 3, 20, 80])
        docs.append((i, " ,;\n"[rng.randrange(4)].join(rng.choices(words, k=n))))
    docs += [docs[5]] * 3 + [(None, docs[3][1]), (None, "the of a"), (70, None), (71, "!!! --"), (72, "a\x00b_c")]
    docs += [(100 + i, "the w1 w2 copies") for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for i in range(12)]
    items += [(20, "the w1 copies"), (20, "w2"), (21, None), (22, ""), (None, "w3 the"), (23, "nowhere"), (1, items[1][1])]
    return docs, items


@pytest.mark.parametrize("seed,shard,batch", [(0, 2048, 256), (1, 7, 256), (2, 64, 2), (3, 1, 1)])
def test_equal_to_scoring_everything(spark, monkeypatch, seed, shard, batch):
    docs, items = made(seed)
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked, "BATCH", batch)
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", 50 * shard)
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 400 * (seed + 1))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("y"))
    got = rank_documents(d.repartition(3), i)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank_documents(d.limit(0), i).count() == 0
    assert rank_documents(d, i.limit(0)).count() == 0
    assert [r["doc_id"] for r in rank_documents(d, i).collect()] == [1]


def test_very_long_texts(spark):
    docs = [(1, "word " * 400_000 + "rare"), (2, "rare word"), (3, "x" * 2_000_000)]
    items = [(1, "rare"), (2, " ".join(f"t{i}" for i in range(50_000)) + " word")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, rank_documents(d, i).collect())) == plain(docs, items)


def test_bound_holds_and_intervals_are_dropped():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 8, 500)
    term = np.concatenate([rng.choice(30, n, replace=False) for n in size])
    tf = rng.integers(1, 5, len(term))
    shard = Shard(size, term, tf, rng.integers(10, 300, 500), rng.integers(0, 5000, 30))
    lists = shard.lists(np.array([1, 4, 7, 9, 99]))
    every = shard.scores(lists, np.arange(500))
    for low, high in [(0, 500), (3, 4), (100, 130), (499, 500), (17, 400)]:
        bound, at = shard.bounds(lists, np.array([low]), np.array([high]))
        assert bound[0] >= every[low:high].max() and low <= at[0] < high or bound[0] == 0
    looked = []
    score = shard.scores
    shard.scores = lambda lists, docs: looked.append(len(docs)) or score(lists, docs)
    best = shard.search(np.array([1, 4, 7, 9, 99]), np.arange(500), np.zeros((2, 0), np.int64), 3)
    order = np.lexsort((np.arange(500), -every))[:3]
    assert best.tolist() == [every[order].tolist(), order.tolist()]
    assert sum(looked) < 250
