from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from curaspan.llm import simhash
from curaspan.llm.components import connected_components
from curaspan.llm.simhash import close_pairs, drop_near_copies, part_masks, simhash_classes


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int]) -> dict[int, int]:
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", range(6))
def test_close_pairs_lose_none(seed):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(20)]
    codes = set()
    for _ in range(300):
        code = rng.choice(centers)
        for _ in range(rng.randint(0, 6)):
            code ^= 1 << rng.randrange(64)
        codes.add(code)
    codes = np.array(sorted(codes), np.uint64)
    group = np.sort(np.array([rng.randrange(3) for _ in codes]))
    found = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in close_pairs(codes, group)))}
    expected = {
        (i, j)
        for i in range(len(codes))
        for j in range(i + 1, len(codes))
        if group[i] == group[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= 3
    }
    assert found == expected


@pytest.mark.parametrize("n", [10, 1 << 30, 1 << 60])
def test_masks_leave_one_part_equal(n):
    rng = random.Random(n)
    masks = part_masks(n)
    for _ in range(300):
        flip = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flip & (m % (1 << 64)) == 0 for m in masks)


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(30)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame(path + star + path + [(500, 500)], "u long, v long")
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert all(found[i] == 0 for i in range(31))
    assert all(found[i] == 100 for i in range(100, 140)) and found[500] == 500
    assert connected_components(edges.limit(0)).count() == 0


def test_classes_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    texts = [None, "", " \t\n", "one", "One two", "ONE  two"]
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(3, 150))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    expected = plain_components(prints)
    for chunk in (simhash.CHUNK, 2):  # the second one cuts parts into chunks
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        found = simhash_classes(df).collect()
        assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
        assert {r["doc_id"]: r["component_id"] for r in found} == expected
        assert all(len(r["fingerprint"]) == 16 for r in found)


def test_real_tables_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    found = simhash_classes(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(prints)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(2, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z"), (7, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash_classes(df).collect()
    assert len(found) == 6
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert simhash_classes(df.limit(0)).count() == 0
    kept = drop_near_copies(df).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 7] and len(kept) == 4
    assert drop_near_copies(df).columns == df.columns


@pytest.mark.parametrize("seed", range(2))
def test_one_row_of_each_group_stays(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", " \n", "one", "One two", "ONE  two", "one two three four five"]
    for _ in range(15):
        base = rng.choices(words, k=rng.randint(5, 200))
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    root = plain_components({i: plain_fingerprint(t) for i, t in enumerate(texts)})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in drop_near_copies(df).collect())
    assert kept == sorted(set(root.values())) and len(kept) < len(texts)


def test_very_long_texts_and_clashing_names(spark):
    long = "alpha beta gamma delta " * 200_000
    rows = [(1, long, 5, "a"), (2, long.upper(), 6, "b"), (3, "x" * 2_000_000, 7, "c"), (4, "short", 8, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long, root string")
    kept = drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["fp"] for r in kept.collect()) == [5, 7, 8]
    found = {r["doc_id"]: r["component_id"] for r in simhash_classes(df).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}


def test_rows_without_an_id_and_unlike_texts_of_one_id(spark):
    rows = [(2, "a b c d"), (2, "x y"), (2, "x y"), (None, "a b c d"), (None, "z"), (None, "z"), (5, "z z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in drop_near_copies(df, null_ids=True).collect()]
    assert sorted(kept, key=str) == sorted({*rows} - {(None, "a b c d")}, key=str)
