from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from curaspan.llm import suffix
from curaspan.llm.suffix import cut_repeats, repeated_bytes, suffix_order


def plain(texts: list[bytes]):
    """Per text, in order: (n_bytes, n_removed, n_spans, hash of the rest)."""
    seen, out = set(), []
    for raw in texts:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            else:
                seen.add(raw[i : i + 100])
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def results(df):
    return {
        r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        for r in repeated_bytes(df).collect()
    }


def made_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(15, 90))) for _ in range(6)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 450, "ab" * 200, "a" * 230]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.6:
                passage = rng.choice(passages)
                a, b = sorted(rng.sample(range(len(passage)), 2))
                parts.append(passage if rng.random() < 0.4 else passage[a:b])
            else:
                parts.append(" ".join(word() for _ in range(rng.randint(1, 40))))
        text = rng.choice([" ", "\n", ""]).join(parts)
        if rng.random() < 0.2 and texts[-1]:
            text = texts[-1]
        if rng.random() < 0.3 and len(text) > 50:
            at = rng.randrange(len(text))
            text = text[:at] + "x" + text[at + 1 :]
        texts.append(text)
    return texts


@pytest.mark.parametrize("seed", range(40))
def test_suffix_order_equals_sorting(seed):
    rng = random.Random(seed)
    for _ in range(50):
        symbols = [rng.randint(0, rng.randint(0, 4)) for _ in range(rng.randint(0, 60))]
        assert suffix_order(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize(
    ("seed", "contexts", "symbols"), [(0, 512, 400_000), (1, 2, 400_000), (2, 512, 200)]
)
def test_equals_brute_force(spark, monkeypatch, seed, contexts, symbols):
    monkeypatch.setattr(suffix, "MAX_CONTEXTS", contexts)
    monkeypatch.setattr(suffix, "SORTED_SYMBOLS", symbols)
    texts = made_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = results(df)
    expected = plain([(t or "").encode() for t in texts])
    assert [found[i] for i in range(len(texts))] == expected


def test_real_tables_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    expected = plain([(r["text"] or "").encode() for r in rows])
    found = results(docs)
    assert [found[r["doc_id"]] for r in rows] == expected


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "".join(random.Random(4).choices("abcdefgh", k=130)) + "é" * 20
    rows = [(5, text, 1), (5, text, 1), (None, text, 1), (6, text + "!", 1), (7, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_spans int")
    found = sorted(
        (str(r["doc_id"]), r["n_removed"]) for r in repeated_bytes(df).collect()
    )
    n = len(text.encode())
    assert found == [("5", n), ("5", n), ("6", n), ("7", 0), ("None", 0)]
    assert repeated_bytes(df.limit(0)).count() == 0


def test_cut_keeps_rows_columns_and_valid_text(spark):
    shared = "".join(random.Random(9).choices("éèàùâêîôû", k=70))
    # The last byte of the character before is shared as well: it goes with the rest.
    before, other = "é", chr(ord("é") + 64)
    rows = [(1, before + shared + "yz", "p"), (2, other + shared + "q", "p"), (3, None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __kept string")
    out = {r["doc_id"]: r for r in cut_repeats(df).collect()}
    assert out[1]["text"] == rows[0][1] and out[2]["text"] == "q" and out[3]["text"] is None
    assert cut_repeats(df).columns == df.columns and out[1]["__kept"] == "p"


@pytest.mark.parametrize("kept", [128, 1 << 18])
def test_anchors_are_the_leftmost_smallest_grams(monkeypatch, kept):
    monkeypatch.setattr(suffix, "KEPT_POWERS", kept)
    suffix._powers.cache_clear()
    rng = random.Random(5)
    multiplier, size = suffix._MULTIPLIER, 1 << 64
    for raw in (b"ab" * 120, b"z" * 100, bytes(rng.choices(b"abc", k=400)), rng.randbytes(300)):
        grams = []
        for i in range(len(raw) - suffix.GRAM + 1):
            window = raw[i : i + suffix.GRAM]
            total = sum((b + 1) * pow(multiplier, j, size) for j, b in enumerate(window)) % size
            grams.append(int(suffix._mixed(np.array([total], np.uint64))[0]))
        places = []
        for i in range(len(raw) - suffix.WINDOW + 1):
            places.append(min(range(i, i + suffix.SPAN), key=lambda g: (grams[g] >> 32, g)))
        hashes, place, first, last = suffix.anchors(raw)
        assert [p for p, a, b in zip(place, first, last) for _ in range(a, b + 1)] == places
        assert [int(h) % size for h in hashes.tolist()] == [grams[p] for p in place.tolist()]
    assert suffix._powers.cache_info().misses <= 1  # not once for every text
