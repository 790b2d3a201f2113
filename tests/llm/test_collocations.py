from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curaspan.llm import collocations
from curaspan.llm.collocations import mine_phrases


def plain(rows, min_count, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every run of words."""
    counts = Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3, 4):
                for i in range(len(words) - n + 1):
                    counts[lang or "und", tuple(words[i : i + n])] += 1
    sizes = Counter()
    for (lang, words), f in counts.items():
        sizes[lang] += f * (len(words) == 1)
    found = {k: f for k, f in counts.items() if f >= min_count and len(k[1]) > 1}
    gone = set()
    for (lang, words), f in found.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                part = lang, words[i : i + n]
                if 100 * f >= 80 * counts[part]:
                    gone.add(part)
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) in gone:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    rows = []
    for lang, own in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(rows)


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "日本", "a\x00b", "x" * 50] + [f"w{i}" for i in range(8)]
    joins = [" ", " ", " ", " ", "\t", ". ", ",", "\n", "  ", "?\x0b", "\r\n"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.choice([0, 1, 2, 5, 40])):
            some = rng.choice([["new", "york", "city"], ["of", "the", "new", "York"], [rng.choice(words)]])
            parts += [" ".join(some), rng.choice(joins)]
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und"]), "".join(parts)))
    return rows + [rows[7]] * 5 + [("en", None), (None, None), ("xx", ""), ("en", " .,; ")]


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_counting_everything(spark, monkeypatch, seed):
    rows = made(seed)
    if seed:
        monkeypatch.setattr(collocations, "STRIPE_PART", 20)
        monkeypatch.setattr(collocations, "PART_BYTES", 100)
        monkeypatch.setattr(collocations, "HELD_ENTRIES", 200)
    if seed == 2:
        monkeypatch.setattr(collocations, "BROADCAST_PREFIXES", 0)
    if seed == 3:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    docs = spark.createDataFrame(rows, "lang string, text string")
    docs = docs.withColumn("phrase", F.lit(1)).withColumn("score", F.lit("x"))
    try:
        got = mine_phrases(docs.repartition(3), min_count=4, top=25)
        assert sorted(map(tuple, got.collect())) == plain(rows, 4, 25)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_empty_and_nothing_frequent(spark):
    docs = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert mine_phrases(docs).count() == 0
    assert mine_phrases(docs.limit(0)).count() == 0
    assert mine_phrases(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_very_long_texts(spark):
    rows = [("en", "big apple pie, " * 200_000), ("en", "big apple " * 100_000), ("en", "x" * 3_000_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, mine_phrases(docs).collect())) == plain(rows, 30, 2000)


def test_products_beyond_64_bits(spark):
    big = 5_000_000_000_000_000
    phrases = spark.createDataFrame([("en", "a b", big, 2)], "lang string, phrase string, a long, size int")
    totals = spark.createDataFrame(
        [("en", "a", 2 * big, big), ("en", "b", 2 * big - 1, 0)], "lang string, phrase string, f long, best long"
    )
    row = collocations._scored(collocations._not_subsumed(phrases, totals), totals).first()
    assert row["score"] == 2_000_000 * big // (4 * big - 1)


def test_known_phrases(spark):
    hashes = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    rows = [(int(i) + 1, int(h)) for i, h in enumerate(hashes)]
    known = collocations.known_phrases(spark.createDataFrame(rows, "f long, h long"), 0)
    assert known.holds(hashes.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert known.holds(other).mean() < 0.1
