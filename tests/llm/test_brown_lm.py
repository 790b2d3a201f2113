from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from curaspan.llm import brown_lm
from curaspan.llm.brown_lm import exchange_classes, score_texts


def plain(texts: dict, training: list[str]):
    def tokens(text):
        return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]

    counts = Counter(w for t in training for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for key, text in texts.items():
        words = tokens(text)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out[key] = (len(words), sum(counts[w] > 0 for w in words), n, score)
    return out


@pytest.mark.parametrize("head", [brown_lm.HEAD_WORDS, 20])
def test_base_score_equals_brute_force(spark, sf_dir, monkeypatch, head):
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", head)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    expected = plain(texts, [t for i, t in texts.items() if not held[i]])
    found = score_texts(docs).collect()
    assert len(found) == len(texts)
    better = 0
    for r in found:
        n, known, train, score = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"]) == (held[r["doc_id"]], n)
        assert (r["n_known"], r["train_tokens"]) == (known, train)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        better += r["held_out"] and r["score"] > r["base_score"]
    assert better > 0.8 * sum(held.values())


def likelihood(bigrams, classes):
    member = np.eye(int(classes.max()) + 1)[classes]
    table = member.T @ bigrams @ member
    rows, columns = table.sum(1), table.sum(0)
    logs = [np.sum(x * np.log(np.maximum(x, 1e-300))) for x in (table, rows, columns)]
    return logs[0] - logs[1] - logs[2]


def test_no_single_move_is_better_afterwards():
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 4, 40)
    bigrams = rng.poisson(1 + 9 * (kind[:, None] == (kind[None, :] + 1) % 4)).astype(float)
    classes = exchange_classes(bigrams, 6)
    assert classes[0] == 0 and (classes[1:] > 0).all()
    best = likelihood(bigrams, classes)
    for unit in range(1, 40):
        for new in range(1, 6):
            moved = classes.copy()
            moved[unit] = new
            assert likelihood(bigrams, moved) <= best + 1e-6


def test_transitions_are_probabilities():
    rng = np.random.default_rng(1)
    bigrams = rng.integers(0, 9, (30, 30)).astype(float)
    classes = exchange_classes(bigrams, 6)
    sums = (10 ** brown_lm.transition_logs(bigrams, classes)).sum(1)
    assert np.allclose(sums, 1)


def test_null_empty_repeated_and_empty_tables(spark):
    rows = [(1, None), (None, ""), (3, "A b"), (3, "A b"), (4, "a " * 50_000), (5, "zzz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score")
    found = score_texts(df).collect()
    assert len(found) == 6
    assert sorted(r["n_tokens"] for r in found) == [1, 1, 2, 3, 3, 50_001]
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in found)
    assert score_texts(df.limit(0)).count() == 0


def test_words_of_one_ending_join_the_classes_of_their_contexts(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "FREQUENT_UNITS", 7)
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", 7)
    left, right = [f"l{i}ing" for i in range(20)], [f"r{i}ing" for i in range(20)]
    learned = [f"aaa {x} ccc" for x in left * 3 + ["leftest"] * 100]
    learned += [f"bbb {x} ddd" for x in right * 3 + ["rightest"] * 80]
    asked = [f"{a} {x[7]} {c}" for a, c in (("aaa", "ccc"), ("bbb", "ddd")) for x in (left, right)]
    rows = [(i, text, i < len(learned)) for i, text in enumerate(learned + asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learned boolean")
    found = {r["doc_id"]: r["score"] for r in score_texts(df, df["learned"]).collect()}
    own_left, other_right, other_left, own_right = (found[len(learned) + i] for i in range(4))
    assert own_left > other_right + 0.5 and own_right > other_left + 0.5


def test_best_classes_equal_the_exchange_of_one_unit():
    rng = np.random.default_rng(2)
    bigrams = rng.poisson(rng.random((30, 30)) * 3).astype(float)
    old = np.r_[0, rng.integers(1, 6, 29)]
    member = np.eye(6)[old]
    table = member.T @ bigrams @ member
    word, side, near, n = [], [], [], []
    for u in range(1, 30):
        own = bigrams[u, u]
        for s, counts in ((0, bigrams[:, u] @ member), (1, bigrams[u] @ member)):
            counts[old[u]] -= own
            for k in np.flatnonzero(counts):
                word.append(u - 1), side.append(s), near.append(k), n.append(counts[k])
        if own:
            word.append(u - 1), side.append(2), near.append(0), n.append(own)
    found = brown_lm.best_classes(table, old[1:], *map(np.array, (word, side, near, n)))
    for u in range(1, 30):
        scores = []
        for k in range(1, 6):
            moved = old.copy()
            moved[u] = k
            scores.append(likelihood(bigrams, moved))
        assert scores[found[u - 1] - 1] == pytest.approx(max(scores), abs=1e-6)


@pytest.mark.parametrize("seed", range(2))
def test_score_equals_the_chain_of_classes_and_emissions(spark, monkeypatch, seed):
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", 12)
    monkeypatch.setattr(brown_lm, "FREQUENT_UNITS", 7)
    rng = random.Random(seed)
    made = [rng.choice([f"aaa l{rng.randrange(20)}ing ccc", f"bbb r{rng.randrange(20)}ing ddd"]) for _ in range(300)]
    rows = [(i, " ".join(made[k : k + 2])) for i, k in enumerate(range(0, 300, 2))]
    rows += [(200, "Never seen aaa"), (201, None), (202, "l1ing l1ing r3ing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learned = df["doc_id"] < 120
    texts = df.where(learned).select("text")
    model = brown_lm.ClassModel(texts, brown_lm.written(brown_lm.word_counts(texts), "test-counts"))
    assert len(model.likelihoods) > 1
    assert all(a < b for a, b in zip(model.likelihoods, model.likelihoods[1:]))
    known = {bytes(r["word"]): (r["c"], r["k"]) for r in model.words.collect()}
    found = {r["doc_id"]: r["score"] for r in score_texts(df, learned).collect()}
    for i, text in rows:
        score, last = 0.0, 0
        for word in brown_lm.tokens((text or "").encode()):
            c, k = known.get(word, (0, int(model.unit_classes[model.units[word]])))
            score += model.transitions[last, k] + math.log10(c + 1) - model.emission_logs[k]
            last = k
        assert found[i] == pytest.approx(score, abs=1e-9)


def test_bigrams_of_two_head_words_stay_out_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", 3)
    monkeypatch.setattr(brown_lm, "FREQUENT_UNITS", 3)
    asked = []
    monkeypatch.setattr(brown_lm, "written", lambda df, name: asked.append((name, df.cache())) or asked[-1][1])
    texts = spark.createDataFrame([("aaa bbb " * 50 + "zing",), ("aaa bbb ring zing",)], "text string")
    model = brown_lm.ClassModel(texts, brown_lm.word_counts(texts))
    found = {(r["a"], r["b"]): r["c"] for r in dict(asked)["word-bigrams"].collect()}
    bbb, zing, ring = model.keys[b"bbb"], brown_lm.word_key(b"zing"), brown_lm.word_key(b"ring")
    assert found == {(bbb, zing): 1, (zing, 0): 2, (bbb, ring): 1, (ring, zing): 1}
    # Of 107 bigrams, those of head words counted by class inside the tasks.
    words = {r["w"]: r["k"] for r in model.words.collect()}
    head, _ = model._of_head(model.words)
    k = len(model.emission_logs)
    rare = brown_lm.class_table(dict(asked)["word-bigrams"], model.words, model.words.where("w >= 0"), k)
    assert rare.sum() == 5 and rare[words[ring], words[zing]] >= 1
    assert brown_lm.head_table(model.tokens, head, k).sum() == 102
