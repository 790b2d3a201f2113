from __future__ import annotations

import random
import re
import time

import pytest

from conftest import plan_of, shuffled_columns
from curaspan.operators import entities
from curaspan.operators.detect import detect_pii
from curaspan.operators.entities import with_entities

PHRASES = [
    ("John Smith", "PERSON"),
    ("John", "PERSON"),
    ("Smith & Sons", "ORG"),
    ("San Francisco", "GPE"),
    ("San Francisco Giants", "ORG"),
    ("Yahoo!", "ORG"),
    ("a.b", "ORG"),
    ("C++", "ORG"),
    ("\\E(", "ORG"),
    ("x\\Ey", "ORG"),
    ("naïve", "ORG"),
    ("!!", "ORG"),
]


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(PHRASES, "phrase string, label string")


def found(texts, dictionary, *values):
    rows = texts(*values).transform(with_entities(dictionary)).orderBy("record_id").collect()
    return [
        [(e["label"], e["matched_text"], e["start"], e["end"]) for e in (r["entities"] or [])] for r in rows
    ]


def brute_force(text):
    """All places of all phrases between word edges, longest first, then earliest."""
    spans = []
    for phrase, label in PHRASES:
        if not re.search(r"\w", phrase):
            continue
        before = r"(?<!\w)" if re.match(r"\w", phrase) else ""
        after = r"(?!\w)" if re.search(r"\w\Z", phrase) else ""
        for m in re.finditer(before + re.escape(phrase) + after, text):
            spans.append((label, phrase, m.start(), m.end()))
    taken, kept = set(), []
    for span in sorted(spans, key=lambda s: (-(s[3] - s[2]), s[2])):
        covered = set(range(span[2], span[3]))
        if not covered & taken:
            taken |= covered
            kept.append(span)
    return sorted(kept, key=lambda s: s[2])


def test_cases(texts, dictionary):
    values = [
        "Please call John Smith tomorrow, John.",
        "Johnson met Johns",
        "the San Francisco Giants left San Francisco",
        "Yahoo! or Yahoo",
        "John Smith & Sons",
        "a.b aXb",
        "",
        None,
    ]
    result = found(texts, dictionary, *values)
    assert [[e[:2] for e in r] for r in result] == [
        [("PERSON", "John Smith"), ("PERSON", "John")],
        [],
        [("ORG", "San Francisco Giants"), ("GPE", "San Francisco")],
        [("ORG", "Yahoo!")],
        [("PERSON", "John"), ("ORG", "Smith & Sons")],
        [("ORG", "a.b")],
        [],
        [],
    ]


def test_against_brute_force(texts, dictionary):
    rng = random.Random(5)
    words = [
        "John", "Smith", "&", "Sons", "San", "Francisco", "Giants", "Yahoo!", "Yahoo", "a.b", "a", ".", "b", "C++",
        "\\E(", "x\\Ey", "naïve", "naïvely", "😀", "_", "!!",
    ]
    values = [
        "".join(rng.choice(words) + rng.choice([" ", " ", " ", "", ", ", "  "]) for _ in range(rng.randint(1, 15)))
        for _ in range(1500)
    ]
    for value, result in zip(values, found(texts, dictionary, *values)):
        assert result == brute_force(value), repr(value)


def test_large_dictionary_is_not_broadcast(spark, texts, dictionary, monkeypatch):
    monkeypatch.setattr(entities, "BROADCAST_PHRASES", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = texts("call John Smith", "nobody").transform(with_entities(dictionary))
        assert "BroadcastHashJoin" not in plan_of(df)
        rows = df.orderBy("record_id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [e["matched_text"] for e in rows[0]["entities"]] == ["John Smith"] and rows[1]["entities"] is None


def test_empty_dictionary(texts, dictionary):
    assert found(texts, dictionary.limit(0), "John Smith") == [[]]


def test_both_layers(spark, texts, dictionary):
    from pyspark.sql import functions as F

    df = texts("John Smith, john@yahoo.com, San Francisco").transform(with_entities(dictionary))
    spans = df.transform(detect_pii(entities=F.col("entities"))).first()["pii_detections"]
    assert [(s["pii_type"], s["layer"], s["confidence"]) for s in spans] == [
        ("PERSON", "ner", 0.80), ("EMAIL", "regex", 0.99), ("GPE", "ner", 0.65),
    ]


def test_rows_without_an_id_are_looked_up(spark, dictionary):
    df = spark.createDataFrame([(None, "John Smith"), (None, "John"), ("a", None)], "record_id string, text string")
    rows = {r["text"]: r["entities"] for r in df.transform(with_entities(dictionary)).collect()}
    assert [e["matched_text"] for e in rows["John Smith"]] == ["John Smith"]
    assert [e["matched_text"] for e in rows["John"]] == ["John"] and rows[None] is None


def test_many_phrases_in_one_text_are_linear(spark, texts):
    """No regex per phrase: twice the phrases take about twice the time."""

    def seconds(n):
        names = [f"Name{i} Of{i}" for i in range(n)]
        phrases = spark.createDataFrame([(name, "ORG") for name in names], "phrase string, label string")
        df = texts(" met ".join(names)).transform(with_entities(phrases))
        started = time.perf_counter()
        assert len(df.first()["entities"]) == n
        return time.perf_counter() - started

    seconds(500)
    assert seconds(8000) < 1.5 * 4 * max(seconds(2000), 0.5)


def test_text_moves_once(texts, dictionary):
    moved = shuffled_columns(texts("John Smith").transform(with_entities(dictionary)))
    assert sum("text#" in columns for columns in moved) <= 1


def test_streams_are_refused_with_a_reason(spark, dictionary):
    stream = spark.readStream.format("rate").load().selectExpr("cast(value as string) as text")
    with pytest.raises(ValueError, match="foreachBatch"):
        stream.transform(with_entities(dictionary))


def test_runs_leave_a_text_only_at_set_bits(spark, sf_dir):
    """At most a fifth of all runs of the dictionary's lengths, and every hit among them."""
    from curaspan.plans import views
    from pyspark.sql import functions as F

    notes = views.shipping_notes(spark, sf_dir)
    phrases = entities._phrases(views.entity_dictionary(spark, sf_dir))
    runs = entities.candidate_runs(notes, phrases).where("core IS NOT NULL").count()
    words = F.regexp_count("text", F.lit(entities._WORDS))
    lengths = [r["n"] for r in phrases.select("n").distinct().collect()]
    every = notes.select(sum((F.greatest(words - n + 1, F.lit(0)) for n in lengths), F.lit(0)).alias("n"))
    hits = notes.transform(with_entities(views.entity_dictionary(spark, sf_dir))).agg(F.sum(F.size("entities")))
    assert hits.first()[0] <= runs <= every.agg(F.sum("n")).first()[0] / 5


def test_phrases_are_filed_under_their_rarest_word(spark):
    names = ["the bank of wales", "the bank", "the of", "wales coal"]
    rows = entities._phrases(
        spark.createDataFrame([(n, "ORG") for n in names], "phrase string, label string")
    ).collect()
    # Ties go to the longer word, then to the earlier one.
    assert {r["phrase"]: (r["anchor"], r["k"], r["n"]) for r in rows} == {
        "the bank of wales": ("wales", 3, 4), "the bank": ("bank", 1, 2), "the of": ("of", 1, 2),
        "wales coal": ("coal", 1, 2),
    }


def test_full_bitmap_changes_nothing(texts, dictionary, monkeypatch):
    values = ["Please call John Smith tomorrow, John.", "the San Francisco Giants left San Francisco"]
    before = found(texts, dictionary, *values)
    monkeypatch.setattr(entities, "MIN_BITS", 64)
    monkeypatch.setattr(entities, "MAX_BITS", 64)
    assert found(texts, dictionary, *values) == before and before[0]


def test_runs_are_shuffled_with_short_keys(texts, dictionary, monkeypatch):
    """A run takes 16 bytes of key through the shuffles, not 64 letters."""
    phrases = entities._phrases(dictionary)
    runs = entities.candidate_runs(texts("call John Smith", None), phrases).where("core IS NOT NULL")
    rows = [(r["core"], r["at"], len(r["__key"])) for r in runs.collect()]
    assert {("John Smith", 5, 16), ("John", 5, 16)} <= set(rows) and len(set(rows)) == len(rows)


def test_runs_behind_many_words(texts, dictionary):
    """Places after the first blocks of parts; a run that lies across two of them."""
    values = ["a, " * n + "😀 San Francisco Giants; John Smith" for n in (61, 62, 63, 64, 127, 128, 400)]
    for value, result in zip(values, found(texts, dictionary, *values)):
        assert result == brute_force(value) and len(result) == 2
