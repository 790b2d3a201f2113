from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from curaspan.llm.rules import apply_rules, rule_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(repeated)


@pytest.mark.parametrize("seed", range(30))
def test_counts_equal_brute_force(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "é日", "a b", "\n", "\n\n", " ", "\t", "\x0b", "\x1c", "\xa0", "#|", "😀", "\r\n"]
    for _ in range(40):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert rule_counts(text.encode()) == plain(text), repr(text)


def test_verdicts_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = {r["doc_id"]: r for r in apply_rules(docs, labels.where("quality = 1")).collect()}
    for row in docs.collect():
        r = found[row["doc_id"]]
        counts = plain(row["text"])
        assert counts == (
            r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
        )
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["kept"] and r["base_failed"])
    for row in labels.collect():
        r = found[row["doc_id"]]
        if not r["base_failed"]:
            assert r["kept"] == (row["quality"] == 1)


def test_null_empty_long_repeated_and_clashing(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None), (None, ""), (2, clean), (2, clean), (3, "y" * 500_000), (4, "a b " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x"))
    trusted = spark.createDataFrame([(2,), (2,), (None,), (77,)], "doc_id long")
    out = apply_rules(docs, trusted).collect()
    assert [r["kept"] for r in out if r["doc_id"] == 2] == [True, True]
    assert sum(r["kept"] for r in out) == 2 and len(out) == 6
    assert apply_rules(docs.limit(0), trusted).count() == 0
    without = apply_rules(docs, trusted.limit(0)).collect()
    assert {r["log_ratio"] for r in without} == {0.0}
