from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from brute_force import best_subset, candidates
from conftest import plan_of
from curaspan.functions import spans
from curaspan.functions.patterns import DEFAULT_PATTERNS, PiiPattern, patterns_by_type
from curaspan.operators.detect import detect_candidates, detect_pii, explode_detections
from curaspan.plans import views
from curaspan.schemas import DETECTION_TYPE


def spans_of(df):
    """Per record in id order: [(type, text, start, end, confidence)]."""
    rows = df.transform(detect_pii()).orderBy("record_id").collect()
    return [
        [(d["pii_type"], d["matched_text"], d["start"], d["end"], d["confidence"]) for d in r["pii_detections"]]
        for r in rows
    ]


CASES = [
    ("", []),
    (None, []),
    ("Nothing to hide in this line about the weather.", []),
    ("version 1.2.3, build 300.1.2.4", []),
    ("Parcel desk: desk-7@parcels.example.org!", [("EMAIL", "desk-7@parcels.example.org")]),
    ("from <mia.k+news@post.example>", [("EMAIL", "mia.k+news@post.example")]),
    ("ring 212-555-0147 after nine", [("PHONE_US", "212-555-0147")]),
    ("fax: (305) 555-0118", [("PHONE_US", "(305) 555-0118")]),
    ("2125550147 or +1 212 555 0147", [("PHONE_US", "2125550147"), ("PHONE_US", "+1 212 555 0147")]),
    ("tax id 219-09-9999 on page two", [("SSN", "219-09-9999")]),
    ("paid with 5500-0000-0000-0004", [("CREDIT_CARD", "5500-0000-0000-0004")]),
    ("paid with 6011 0000 0000 0004 today", [("CREDIT_CARD", "6011 0000 0000 0004")]),
    ("gateway 172.16.254.1 is down", [("IP_ADDRESS", "172.16.254.1")]),
    (
        "172.16.254.1 belongs to it@lab.example, extension 646-555-0193",
        [
            ("IP_ADDRESS", "172.16.254.1"),
            ("EMAIL", "it@lab.example"),
            ("PHONE_US", "646-555-0193"),
        ],
    ),
    (
        "219-09-9999 / 646-555-0193",
        [("SSN", "219-09-9999"), ("PHONE_US", "646-555-0193")],
    ),
]


def test_cases(texts):
    found = spans_of(texts(*[text for text, _ in CASES]))
    assert [[s[:2] for s in own] for own in found] == [want for _, want in CASES]


def test_offsets_point_at_the_match(texts):
    values = [text for text, _ in CASES] + ["😀é 192.168.1.1 😀 a@b.co", "日本 123-45-6789"]
    for value, own in zip(values, spans_of(texts(*values))):
        for _, matched, start, end, _ in own:
            assert value[start:end] == matched


def test_columns_types_and_defaults(texts):
    source = texts("a@b.co and 1.2.3.4 and c@d.io", None)
    out = source.transform(detect_pii())
    assert source.columns == ["record_id", "text"]
    assert out.columns == [
        "record_id", "text", "pii_detections", "pii_types_found", "has_pii", "pii_count", "max_pii_confidence",
    ]
    assert out.schema["pii_detections"].dataType.simpleString() == DETECTION_TYPE.simpleString()
    first, second = out.orderBy("record_id").collect()
    assert first["pii_types_found"] == ["EMAIL", "IP_ADDRESS"]
    assert (first["has_pii"], first["pii_count"], first["max_pii_confidence"]) == (True, 3, 0.99)
    assert all(d["layer"] == "regex" for d in first["pii_detections"])
    assert (second["has_pii"], second["pii_count"], second["max_pii_confidence"]) == (False, 0, 0.0)
    assert second["pii_detections"] == [] and second["pii_types_found"] == []


def test_registry():
    assert [p.pii_type for p in DEFAULT_PATTERNS] == ["EMAIL", "PHONE_US", "SSN", "CREDIT_CARD", "IP_ADDRESS"]
    assert [p.confidence for p in DEFAULT_PATTERNS] == [0.99, 0.95, 0.99, 0.95, 0.85]
    assert set(patterns_by_type()) == {p.pii_type for p in DEFAULT_PATTERNS}


def test_added_pattern(texts):
    ticket = PiiPattern("TICKET", "TICKET", 0.9, r"[A-Z]{2}-[0-9]+")
    out = texts("see AB-12, mail a@b.co").transform(detect_pii(patterns=[*DEFAULT_PATTERNS, ticket]))
    assert out.first()["pii_types_found"] == ["EMAIL", "TICKET"]


def _random_text(rng: random.Random) -> str:
    pieces = [
        "a@b.co", "x.y+z@mail-1.example.com", "@", ".", "-", " ", "\t", "\n", "\x1c", "1", "12", "123", "1234",
        "4155550192", "415-555-0192", "(415) 555", "+1", "123-45-6789", "4111 1111 1111 1111", "4111111111111",
        "10.0.0.1", "255.255.255.255", "256.1.1.1", "é", "ß", "_", "²", "Ⅷ", "٣٣٣", "٤", "😀", "日", "K", "ſ",
        "ı@İ.com", "a@b.co_c@d.io", "…", " ", "́", "x", "com", "((", "))",
    ]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))


@pytest.mark.parametrize("short", [spans.SHORT, 1])
def test_against_brute_force(texts, monkeypatch, short):
    """Both the forms for few and for many spans."""
    monkeypatch.setattr(spans, "SHORT", short)
    rng = random.Random(7)
    values = [_random_text(rng) for _ in range(4000)]
    df = texts(*values)
    rows = df.transform(detect_candidates()).orderBy("record_id").collect()
    for value, row in zip(values, rows):
        found = [(c["start"], c["end"], c["pii_type"], c["confidence"]) for c in row["pii_candidates"]]
        assert found == candidates(value), repr(value)
    for value, own in zip(values, spans_of(df)):
        found = [(start, end, kind, confidence) for kind, _, start, end, confidence in own]
        assert found == best_subset(candidates(value)), repr(value)


def test_many_spans_in_one_text(texts):
    """More spans than one growth chunk, overlapping ones among them."""
    value = " ".join(f"ops@10.20.{i % 256}.{i // 256}.example.com 10.9.{i % 256}.1" for i in range(1500))
    (own,) = spans_of(texts(value))
    assert [(s[2], s[3], s[0], s[4]) for s in own] == best_subset(candidates(value))
    assert len(own) == 3000


def test_long_unbroken_run_is_linear(texts):
    value = "x" * 300_000 + " a@b.co"
    (own,) = spans_of(texts(value))
    assert [s[1] for s in own] == ["a@b.co"]


def test_no_overlap_on_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    detected = documents.transform(detect_pii())
    bad = detected.where(
        F.exists(
            F.zip_with(
                "pii_detections",
                F.slice("pii_detections", 2, 1_000_000),
                lambda a, b: F.coalesce(b["start"] < a["end"], F.lit(False)),
            ),
            lambda clash: clash,
        )
    )
    assert bad.count() == 0
    exploded = explode_detections(detected, "doc_id", "text")
    wrong = exploded.where(F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")) != F.col("matched_text"))
    assert exploded.count() > 0 and wrong.count() == 0


def test_entity_layer(spark, texts):
    """A user function as the second layer: overlap goes to the pattern, unknown labels drop out."""

    @pandas_udf("array<struct<label:string,start:int,end:int,matched_text:string>>")
    def entities(values):
        import pandas as pd

        def find(text):
            names = [("PERSON", "Ada Okafor"), ("ORG", "lab.example"), ("DATE", "today")]
            return [
                {"label": label, "start": text.find(name), "end": text.find(name) + len(name), "matched_text": name}
                for label, name in names
                if name in text
            ]

        return pd.Series([find(v) for v in values])

    out = texts("Ask Ada Okafor under a@lab.example today").transform(detect_pii(entities=entities))
    found = [(d["pii_type"], d["layer"], d["confidence"]) for d in out.first()["pii_detections"]]
    assert found == [("PERSON", "ner", 0.80), ("EMAIL", "regex", 0.99)]


@pytest.mark.parametrize("shuffles", [0])
def test_plan_is_narrow(spark, sf_dir, shuffles):
    documents = views.table(spark, sf_dir, "documents")
    plan = plan_of(documents.transform(detect_pii()).select("doc_id", "pii_detections"))
    assert plan.count("Exchange") == shuffles
    assert "Python" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_span_explode_does_not_repeat_detection(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    plan = plan_of(explode_detections(documents.transform(detect_pii()), "doc_id"))
    assert plan.count("regexp_extract_all") == len(DEFAULT_PATTERNS)


def test_union_covers_every_candidate(texts):
    rng = random.Random(3)
    parts = ["212-555-0147", "@lab.example", "219-09-9999", "5500-0000-0000-0004", "10.1.2.3", " ", "-", "a"]
    values = ["".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(80)]
    df = texts(*values).transform(detect_candidates())
    joined = df.transform(spans.union_overlaps, "pii_candidates", "joined")
    for row in joined.collect():
        def places(found):
            return {k for s in found for k in range(s["start"], s["end"])}

        assert places(row["joined"]) == places(row["pii_candidates"])
        ordered = row["joined"]
        assert all(a["end"] <= b["start"] for a, b in zip(ordered, ordered[1:]))
        for one in ordered:
            inside = [c for c in row["pii_candidates"] if one["start"] <= c["start"] and c["end"] <= one["end"]]
            assert one["confidence"] == max(c["confidence"] for c in inside)
