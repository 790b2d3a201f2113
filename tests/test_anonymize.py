from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from curaspan.functions.tokens import pseudo_token, redact_token, strategy_for
from curaspan.operators.anonymize import anonymize
from curaspan.operators.detect import detect_pii
from curaspan.plans import views


def run(df, **options):
    return df.transform(detect_pii()).transform(anonymize(**options)).orderBy("record_id").collect()


def digest(value: str, digits: int = 8) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:digits]


def test_token_format(spark):
    row = spark.range(1).select(
        pseudo_token(F.lit("EMAIL"), F.lit("john@example.com")).alias("pseudo"),
        pseudo_token(F.lit("EMAIL"), F.lit("john@example.com"), 16, "s").alias("wide"),
        redact_token(F.lit("IP_ADDRESS")).alias("redacted"),
    ).first()
    assert row["pseudo"] == "[EMAIL_855f96e9]" == f"[EMAIL_{digest('john@example.com')}]"
    assert row["wide"] == f"[EMAIL_{digest('sjohn@example.com', 16)}]"
    assert row["redacted"] == "[REDACTED_IP_ADDRESS]"


@pytest.mark.parametrize(
    ("kind", "strategy"),
    [
        ("EMAIL", "pseudonymization"), ("PHONE_US", "pseudonymization"), ("SSN", "pseudonymization"),
        ("CREDIT_CARD", "pseudonymization"), ("PERSON", "pseudonymization"), ("IP_ADDRESS", "redaction"),
        ("ORG", "redaction"), ("GPE", "redaction"), ("SOMETHING", "redaction"),
    ],
)
def test_routing(spark, kind, strategy):
    assert spark.range(1).select(strategy_for(F.lit(kind)).alias("s")).first()["s"] == strategy


def test_replacement_positions(texts):
    rows = run(
        texts(
            "Sender: alice@example.com.",
            "Call 415-555-0192 or email bob@test.com.",
            "alice@example.com is my address.",
            "Send the report to alice@example.com",
            "😀 1.2.3.4 then 1.2.3.4x and é 1.2.3.4",
        )
    )
    alice = f"[EMAIL_{digest('alice@example.com')}]"
    assert rows[0]["anonymized_text"] == f"Sender: {alice}."
    assert rows[1]["anonymized_text"] == (
        f"Call [PHONE_US_{digest('415-555-0192')}] or email [EMAIL_{digest('bob@test.com')}]."
    )
    assert rows[2]["anonymized_text"] == f"{alice} is my address."
    assert rows[3]["anonymized_text"] == f"Send the report to {alice}"
    # By position: the address inside a longer word is not a span and stays.
    assert rows[4]["anonymized_text"] == (
        "😀 [REDACTED_IP_ADDRESS] then 1.2.3.4x and é [REDACTED_IP_ADDRESS]"
    )


def test_batch_columns(texts):
    rows = run(texts("Email alice@example.com for access.", "The build is green.", "At 192.168.1.1 now", None))
    assert [r["anonymization_count"] for r in rows] == [1, 0, 1, 0]
    assert [r["strategies_used"] for r in rows] == [["pseudonymization"], [], ["redaction"], []]
    assert rows[1]["anonymized_text"] == "The build is green." and rows[1]["anonymization_log"] == []
    assert rows[3]["anonymized_text"] == ""
    entry = rows[0]["anonymization_log"][0].asDict(recursive=True)
    assert entry == {
        "original_text": "alice@example.com",
        "replacement": f"[EMAIL_{digest('alice@example.com')}]",
        "pii_type": "EMAIL",
        "strategy": "pseudonymization",
        "position": {"start": 6, "end": 23},
    }


def test_same_value_same_token(texts):
    rows = run(texts("a@b.co", "x a@b.co y", "A@b.co"))
    tokens = [r["anonymization_log"][0]["replacement"] for r in rows]
    assert tokens[0] == tokens[1] != tokens[2]


def test_spans_in_any_order(spark):
    df = spark.createDataFrame(
        [("r0", "ab cd", [("GPE", "cd", 3, 5, 0.65, "ner"), ("ORG", "ab", 0, 2, 0.7, "ner")])],
        "record_id string, text string, pii_detections array<struct<pii_type:string,matched_text:string,"
        "start:int,end:int,confidence:double,layer:string>>",
    )
    row = df.transform(anonymize()).first()
    assert row["anonymized_text"] == "[REDACTED_ORG] [REDACTED_GPE]"
    assert [e["pii_type"] for e in row["anonymization_log"]] == ["ORG", "GPE"]


def test_guards(texts):
    with pytest.raises(ValueError, match="pii_detections"):
        texts("a").transform(anonymize())
    with pytest.raises(ValueError, match="body"):
        texts("a").transform(detect_pii()).transform(anonymize(text_col="body"))
    with pytest.raises(ValueError, match="null_detections"):
        anonymize(null_detections="ignore")


def test_unchecked_rows_fail_closed(texts):
    unchecked = (
        texts("a@b.co").transform(detect_pii()).withColumn("pii_detections", F.nullif("pii_detections", "pii_detections"))
    )
    with pytest.raises(Exception, match="never checked"):
        unchecked.transform(anonymize()).collect()
    assert unchecked.transform(anonymize(null_detections="none")).first()["anonymized_text"] == "a@b.co"


def test_log_restores_the_text(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents").withColumn("record_id", F.col("doc_id").cast("string"))
    rows = documents.transform(detect_pii()).transform(anonymize()).where("pii_count > 0").collect()
    assert rows
    for row in rows:
        text, cursor, restored = row["anonymized_text"], 0, ""
        shift = 0
        for entry in row["anonymization_log"]:
            at = entry["position"]["start"] + shift
            restored += text[cursor:at] + entry["original_text"]
            cursor = at + len(entry["replacement"])
            shift += len(entry["replacement"]) - len(entry["original_text"])
        assert restored + text[cursor:] == row["text"]
