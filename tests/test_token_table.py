from __future__ import annotations

import hashlib
import os
from collections import Counter

import pytest

from curaspan.operators.anonymize import anonymize
from curaspan.operators.detect import detect_pii
from curaspan.operators.token_table import token_table


def digest(value: str, salt: str = "") -> str:
    return hashlib.sha256((salt + value).encode()).hexdigest()


def plain_tokens(values, digits, salt=""):
    """The shortest prefix of at least ``digits`` that no other value has."""
    tokens = {}
    for value in values:
        n = digits
        while any(digest(o, salt)[:n] == digest(value, salt)[:n] for o in values if o != value):
            n += 1
        tokens[value] = f"[EMAIL_{digest(value, salt)[:n]}]"
    return tokens


ADDRESSES = [f"user{i}@example.com" for i in range(120)]


def detected(texts, values):
    return texts(*[f"mail {v} or {v}" for v in values], "none", "", None).transform(detect_pii())


def as_dict(table):
    rows = table.collect()
    assert len({(r["pii_type"], r["original_text"]) for r in rows}) == len(rows)
    return {r["original_text"]: r["replacement"] for r in rows}


@pytest.mark.parametrize("salt", ["", "s"])
def test_only_colliding_tokens_are_lengthened(texts, salt):
    got = as_dict(token_table(detected(texts, ADDRESSES), hex_digits=2, salt=salt))
    assert got == plain_tokens(ADDRESSES, 2, salt)
    assert len(set(got.values())) == len(ADDRESSES)
    assert len({len(t) for t in got.values()}) > 1


def test_default_tokens_are_the_usual_ones(texts):
    got = as_dict(token_table(detected(texts, ADDRESSES)))
    assert got == {v: f"[EMAIL_{digest(v)[:8]}]" for v in ADDRESSES}


def test_tokens_stay_when_rows_are_added(spark, texts, tmp_path):
    path = os.path.join(tmp_path, "tokens")
    token_table(detected(texts, ADDRESSES[:60]), hex_digits=2).write.parquet(path)
    known = spark.read.parquet(path)
    before = as_dict(known)
    after = as_dict(token_table(detected(texts, ADDRESSES[30:]), known, hex_digits=2))
    assert {v: after[v] for v in before} == before
    assert set(after) == set(ADDRESSES) and len(set(after.values())) == len(ADDRESSES)


def test_texts_get_the_tokens_of_the_table(texts):
    df = detected(texts, ADDRESSES)
    table = token_table(df, hex_digits=2)
    expected = plain_tokens(ADDRESSES, 2)
    rows = df.transform(anonymize(hex_digits=2, tokens=table)).orderBy("record_id").collect()
    assert [r["anonymized_text"] for r in rows[:120]] == [
        f"mail {expected[v]} or {expected[v]}" for v in ADDRESSES
    ]
    assert [r["anonymized_text"] for r in rows[120:]] == ["none", "", ""]
    assert max(Counter(r["record_id"] for r in rows).values()) == 1


def test_repeated_rows_and_null_ids_stay(spark):
    df = spark.createDataFrame([(None, "a@b.co"), (None, "a@b.co"), ("x", "1.2.3.4")], "record_id string, text string")
    df = df.transform(detect_pii())
    out = df.transform(anonymize(hex_digits=1, tokens=token_table(df, hex_digits=1)))
    assert sorted(r["anonymized_text"] for r in out.collect()) == [
        f"[EMAIL_{digest('a@b.co')[:1]}]", f"[EMAIL_{digest('a@b.co')[:1]}]", "[REDACTED_IP_ADDRESS]",
    ]


def test_empty_table(texts):
    df = detected(texts, ADDRESSES[:2]).limit(0)
    assert token_table(df).count() == 0
    assert df.transform(anonymize(tokens=token_table(df))).count() == 0
