from __future__ import annotations

import pytest

from curaspan.functions.patterns import PiiPattern
from curaspan.operators.detect import detect_candidates, detect_pii
from curaspan.operators.residual import anonymize_fully

VALUES = [
    "call 415-555-0192@x.com now",  # a phone number inside an address
    "a@b.com4155550192",  # digits that only show once the address is gone
    "mail a@b.co, card 4111-1111-1111-1111",
    "nothing here",
    "",
    None,
    "x" * 200_000 + " a@b.co 192.168.1.1" + " 1" * 50_000,
]


def test_nothing_is_left(texts):
    rows = texts(*VALUES).transform(anonymize_fully())
    assert rows.transform(detect_candidates("anonymized_text")).where("size(pii_candidates) > 0").count() == 0
    got = {r["record_id"]: r for r in rows.collect()}
    assert len(got) == len(VALUES)
    glued = got["r0001"]
    assert glued["residual_spans"] == 1 and glued["anonymization_passes"] == 2
    assert glued["anonymized_text"].startswith("[EMAIL_") and "4155550192" not in glued["anonymized_text"]
    assert [got[f"r{i:04d}"]["residual_spans"] for i in (0, 2, 3, 4, 5, 6)] == [0] * 6
    assert got["r0003"]["anonymized_text"] == "nothing here" and got["r0005"]["anonymized_text"] == ""


def test_overlaps_are_one_span(texts):
    text = "x +1 415-555-0192@x.com y"
    row = texts(text).transform(detect_pii(overlaps="union")).first()
    (span,) = row["pii_detections"]
    candidates = texts(text).transform(detect_candidates()).first()["pii_candidates"]
    assert len(candidates) > 1
    assert span["start"] == min(c["start"] for c in candidates)
    assert span["end"] == max(c["end"] for c in candidates)
    assert span["matched_text"] == text[span["start"] : span["end"]]
    (best,) = texts(text).transform(detect_pii()).first()["pii_detections"]
    assert span["pii_type"] == best["pii_type"]


def test_endless_matches_raise(texts):
    brackets = (PiiPattern(name="B", pii_type="B", confidence=0.9, regex="[\\[a]"),)
    with pytest.raises(RuntimeError, match="after 2 passes"):
        texts("a").transform(anonymize_fully(patterns=brackets, max_passes=2))


def test_wrong_option_and_empty_table(texts):
    with pytest.raises(ValueError, match="overlaps"):
        detect_pii(overlaps="all")
    assert texts("a").limit(0).transform(anonymize_fully()).count() == 0


def test_repeated_rows_null_ids_and_other_columns(spark):
    df = spark.createDataFrame([(None, "a@b.co", 1), (None, "a@b.co", 1)], "record_id string, body string, text int")
    rows = df.transform(anonymize_fully("body")).collect()
    assert len(rows) == 2 and {r["text"] for r in rows} == {1} and "a@b" not in rows[0]["anonymized_text"]
