from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curaspan.llm import langid
from curaspan.llm.langid import letter_points, ngram_buckets, predict_languages, train


def clean(text: str) -> str:
    lower = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
    out = "".join(c if c.isalpha() else " " for c in lower)
    out = " ".join(out.split())
    return f" {out} " if out else ""


def bucket(gram: str) -> int:
    return int(ngram_buckets(np.array([ord(c) for c in gram], np.uint32))[-1])


def plain_model(rows):
    counts, docs = {}, {}
    for text, lang in rows:
        letters = clean(text)
        if lang is None or not letters:
            continue
        docs[lang] = docs.get(lang, 0) + 1
        own = counts.setdefault(lang, {})
        for n in (1, 2, 3):
            for i in range(len(letters) - n + 1):
                b = bucket(letters[i : i + n])
                own[b] = own.get(b, 0) + 1
    return counts, docs


def plain_log(model, lang, text):
    counts, docs = model
    letters, own = clean(text), counts[lang]
    total = sum(own.values()) + 0.5 * 65536
    out = 0.0
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            out += math.log((own.get(bucket(letters[i : i + n]), 0) + 0.5) / total)
    return math.log(docs[lang] / sum(docs.values())) + out / 3


ROWS = [
    (1, "The quick brown fox", "en"), (2, "le renard brun et vif", "fr"),
    (3, "der schnelle braune Fuchs", "de"), (4, "and the lazy dog", "en"),
    (5, "et le chien paresseux", "fr"), (6, "İstanbul'da 12 kedi", None), (8, "und der faule Hund", "de"),
    (10, "the the the", "en"), (11, "123 -- !", "en"), (12, None, "fr"), (13, "", None),
    (None, "le la les", "fr"), (4, "and the lazy dog", "en"), (14, "日本語", None), (9, "ẞ ǅ", "de"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("part", [400_000, 5])
def test_equal_to_plain_bayes(spark, monkeypatch, part):
    monkeypatch.setattr(langid, "PART_POINTS", part)
    learned = [(t, lang) for i, t, lang in ROWS if not held(i)]
    model = plain_model(learned)
    names, priors, logs = train(table(spark, [r for r in ROWS if not held(r[0])]))
    assert names == sorted(model[0])
    for _, text, _ in ROWS:
        if clean(text):
            got = langid.log_posteriors([text.encode()], priors, logs)[0]
            want = np.array([plain_log(model, lang, text) for lang in names])
            want -= np.log(np.exp(want - want.max()).sum()) + want.max()
            assert np.allclose(got, want)


def test_rows(spark):
    docs = table(spark, ROWS).withColumn("score", F.lit("x")).withColumn("held_out", F.lit(1))
    out = predict_languages(docs).collect()
    assert len(out) == len(ROWS)
    by_text = {(r["doc_id"]): r for r in out}
    for i in (11, 12, 13):
        assert (by_text[i]["lang_pred"], by_text[i]["score"]) == ("und", 0.0)
    for r in out:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1
    assert by_text[1]["lang_pred"] == "en" and by_text[3]["lang_pred"] == "de"


def test_nothing_learned_and_empty(spark):
    docs = table(spark, [(1, "abc", None), (2, "...", "en")])
    assert {(r["lang_pred"], r["score"]) for r in predict_languages(docs).collect()} == {("und", 0.0)}
    assert predict_languages(docs.limit(0)).count() == 0


def test_too_many_languages(spark):
    docs = spark.range(8000).selectExpr("id doc_id", "'abc' text", "cast(id as string) lang")
    with pytest.raises(ValueError, match="not a column of languages"):
        predict_languages(docs)


def test_very_long_text(spark):
    rows = [(1, "the and of " * 200_000, "en"), (4, "le la les " * 10, "fr"), (3, "the and of", "en")]
    out = {r["doc_id"]: r["lang_pred"] for r in predict_languages(table(spark, rows)).collect()}
    assert out == {1: "en", 4: "fr", 3: "en"}


def test_no_letter_is_lost_at_spaces():
    assert "".join(map(chr, letter_points("  Ab1c\n".encode()))) == " ab c "
    assert len(letter_points(b"42")) == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
