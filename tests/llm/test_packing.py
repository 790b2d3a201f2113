from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curaspan.llm.packing import SEQUENCE_TOKENS, _word_ids, pack, plan_slots

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(counts, capacity):
    """Sequences that best-fit decreasing opens, one piece at a time."""
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [f for f in free if f >= length]
            room = min(fitting, default=capacity)
            if fitting:
                free.remove(room)
            free.append(room - length)
    return len(free)


def check_layout(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for slots in by_sequence.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= SEQUENCE_TOKENS
    return len(by_sequence)


def test_word_ids_equal_the_tokenizer():
    rng = random.Random(1)
    parts = [
        "a", "B", "é", " ", "  ", "\n", " \n", "\r\n", "'s", "'", "'ll", "<|endoftext|>", "12",
        "!!", "\x1c", "\x85", "日本", "😀", "\x00", "the", " word",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    plain = Tokenizer.from_file(PATH)
    made = _word_ids(PATH).encode(texts)
    for text, ids in zip(texts, made):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)


@pytest.mark.parametrize("seed", range(20))
def test_plan_fills_every_rank_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(1, 30))}
    used, placed = {}, {}
    for length, low, high, first, each, start in plan_slots(counts, 64):
        for rank in range(low, high):
            at = rank - low
            placed.setdefault(length, set()).add(rank)
            slot = (first + at // each, start + at % each * length)
            used.setdefault(slot[0], []).append((slot[1], length))
    assert {k: len(v) for k, v in placed.items()} == counts
    for slots in used.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 64
    assert len(used) == plain_best_fit(counts, 64)


def test_documents_are_cut_and_packed(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack(docs, PATH).collect()
    plain = Tokenizer.from_file(PATH)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    total = 0
    for doc in docs.collect():
        ids = plain.encode(doc["text"] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        start = 0
        own = sorted(pieces[doc["doc_id"]], key=lambda r: r["piece"])
        for i, r in enumerate(own):
            assert (r["piece"], r["start"]) == (i, start)
            assert i == 0 or r["length"] == SEQUENCE_TOKENS
            cut = np.array(ids[start : start + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(cut)
            start += r["length"]
        assert start == len(ids)
    assert check_layout(rows) <= -(-total // SEQUENCE_TOKENS) * 1.01 + 1


def test_null_empty_repeated_and_empty_tables(spark):
    rows = [(1, None, 5), (1, "", 5), (None, "word", 5), (2, "word", 5), (2, "word", 5)]
    rows.append((3, "ab " * 30_000, 5))
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    out = pack(df, PATH).collect()
    short = [r for r in out if r["doc_id"] != 3]
    assert sorted(r["length"] for r in short) == [1, 1, 2, 2, 2]
    assert sum(r["length"] for r in out if r["doc_id"] == 3) > 30_000
    check_layout(out)
    assert pack(df.limit(0), PATH).count() == 0
