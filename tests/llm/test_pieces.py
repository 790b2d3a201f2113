from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from curaspan.llm import pieces
from curaspan.llm.pieces import (
    SPACE,
    decode_pieces,
    row_seeds,
    sample_digest,
    sample_pieces,
    sample_texts,
    vocabulary,
)

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(text: str, alpha: float = 1.0) -> dict[tuple, float]:
    """Log probability of every segmentation, by enumeration."""
    vocab = vocabulary(PATH, alpha)
    marked = SPACE + text.replace(" ", SPACE)

    def ways(at):
        if at == len(marked):
            return [((), 0.0)]
        found = []
        for end in range(at + 1, len(marked) + 1):
            piece = marked[at:end]
            if piece in vocab.pieces:
                i, weight = vocab.pieces[piece]
                head, log = (i,), weight
            elif end == at + 1:
                head = tuple(vocab.byte_ids[b] for b in piece.encode())
                log = vocab.byte_weight * len(head)
            else:
                continue
            found += [(head + rest, log + more) for rest, more in ways(end)]
        return found

    logs = dict(ways(0))
    total = np.logaddexp.reduce(list(logs.values()))
    return {ids: log - total for ids, log in logs.items()}


@pytest.mark.parametrize("text", ["ab", "the a", "日 x", "a  b", "\n\tq", "ééa"])
def test_probabilities_and_distinctness(text):
    vocab = vocabulary(PATH)
    expected = all_segmentations(text)
    seeds = row_seeds(list(range(300)))
    for rows in sample_texts(vocab, [text] * 300, seeds, 4):
        keys = [tuple(ids.tolist()) for ids, *_ in rows]
        assert len(set(keys)) == len(keys) == min(4, len(expected))
        values = [value for _, _, value, _ in rows]
        assert values == sorted(values, reverse=True)
        for key, (_, log, _, share) in zip(keys, rows):
            assert log == pytest.approx(expected[key], abs=1e-9)
            assert share <= 0


@pytest.mark.parametrize("noted", [512, 2])
def test_chunks_beyond_the_first_are_drawn_alike(monkeypatch, noted):
    """Where siblings may matter all chunks are looked at; elsewhere the draw is the same."""
    monkeypatch.setattr(pieces, "FIRST_CHUNKS", noted)
    vocab = vocabulary(PATH, 0.2)
    text = "the of the"
    expected = {k: math.exp(v) for k, v in all_segmentations(text, 0.2).items()}
    n = 6000
    found = sample_texts(vocab, [text] * n, row_seeds(list(range(n))), 3)
    first = Counter(tuple(rows[0][0].tolist()) for rows in found)
    for key, p in sorted(expected.items(), key=lambda x: -x[1])[:20]:
        assert first[key] / n == pytest.approx(p, abs=0.025)
    long = "the of " * 400
    rows = sample_texts(vocab, [long] * 40, row_seeds(list(range(40))), 3)
    assert all(len({tuple(r[0].tolist()) for r in own}) == 3 for own in rows)
    share = Counter(r[0][1] for own in rows for r in own)
    assert len(share) > 0


def test_first_sample_and_pairs_follow_the_distribution():
    vocab = vocabulary(PATH, 0.2)
    expected = {k: math.exp(v) for k, v in all_segmentations("the", 0.2).items()}
    n = 20_000
    first, pairs = Counter(), Counter()
    weights = Counter()
    for rows in sample_texts(vocab, ["the"] * n, row_seeds(list(range(n))), 2):
        keys = [tuple(r[0].tolist()) for r in rows]
        first[keys[0]] += 1
        pairs[tuple(keys)] += 1
        for key, row in zip(keys, rows):
            weights[key] += math.exp(row[1] - row[3])
    for key, p in expected.items():
        assert first[key] / n == pytest.approx(p, abs=0.015)
        # Probability over inclusion probability is an unbiased estimate of the probability.
        assert weights[key] / n == pytest.approx(p, abs=0.03)
    for (a, b), count in pairs.items():
        assert count / n == pytest.approx(expected[a] * expected[b] / (1 - expected[a]), abs=0.015)


def test_ids_decode_as_the_library_does(spark):
    rng = random.Random(2)
    parts = ["the", " ", "  ", "é", "日本", "😀", "\n", "Word", "x1", ",", "\t", " of"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(60)]
    texts += ["a" * 3000, "q😀" * 300, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sample_pieces(df, PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    decoded = decode_pieces(found, PATH).collect()
    for r in decoded:
        assert r["text"] == texts[r["doc_id"]]
        assert library.decode(list(r["ids"])) == texts[r["doc_id"]]
    assert all(r["decodes"] for r in sample_digest(df, PATH).collect())


def test_seeded_by_key_not_by_place(spark):
    rows = [(i, f"some words of text number {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(tuple, sample_digest(df.repartition(1), PATH).collect()))
    many = sorted(map(tuple, sample_digest(df.orderBy("text").repartition(7), PATH).collect()))
    for a, b in zip(one, many):
        assert a[:4] == b[:4] and a[4:7] == pytest.approx(b[4:7])


def test_null_empty_repeated_and_clashing(spark):
    rows = [(1, None), (None, ""), (2, "a b"), (2, "a b"), (3, SPACE + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    out = sample_digest(df, PATH).collect()
    empty = [r for r in out if r["doc_id"] in (1, None)]
    assert [(r["n_pieces"], r["log_inclusion"]) for r in empty] == [(0, 0.0)] * 2
    twice = sorted(tuple(r) for r in out if r["doc_id"] == 2)
    assert twice[::2] == twice[1::2]
    assert not any(r["decodes"] for r in out if r["doc_id"] == 3)
    assert sample_digest(df.limit(0), PATH).count() == 0


def test_noise_is_hashed_once_for_every_edge_of_a_noted_chunk(monkeypatch):
    vocab = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    lattices = pieces._Lattices(vocab, ["the same words again, the same words"])
    hashed = []
    mix = pieces._mix
    monkeypatch.setattr(pieces, "_mix", lambda x: hashed.append(len(x)) or mix(x))
    token = np.arange(len(lattices.doc))
    steps, others = lattices.walk(
        token, lattices.start[token], np.zeros(len(token), np.uint64), np.ones(len(token), bool)
    )
    # The chunks' seeds, and all edges of every place on the way.
    assert sum(hashed) == len(token) + len(steps[0]) + len(others[0])


def test_lattices_are_made_once_for_all_slices_and_change_no_sample(monkeypatch):
    vocab = pieces.vocabulary(PATH)
    made = []
    edges = vocab.edges
    monkeypatch.setattr(vocab, "edges", lambda chunks: made.extend(chunks) or edges(chunks))
    texts = ["one text of words", "words of another text, é日", "", "one text of words of 日"]
    seeds = row_seeds(list(range(4)))
    kept = pieces._Kept(vocab)
    found = [sample_texts(vocab, [t], seeds[i : i + 1], 3, kept)[0] for i, t in enumerate(texts)]
    assert len(made) == len(set(made)) == 8
    # Nor does it matter that the kept ones are given up.
    monkeypatch.setattr(pieces, "KEPT_CHARACTERS", 10)
    kept = pieces._Kept(vocab)
    again = [sample_texts(vocab, [t], seeds[i : i + 1], 3, kept)[0] for i, t in enumerate(texts)]
    for rows in (found, again):
        for own, alone in zip(rows, sample_texts(vocab, texts, seeds, 3)):
            assert [r[0].tolist() for r in own] == [r[0].tolist() for r in alone]
            assert [r[1:] for r in own] == [pytest.approx(r[1:], abs=1e-9) for r in alone]


def test_siblings_left_out_early_are_not_among_the_best(monkeypatch):
    vocab = pieces.vocabulary(PATH, 0.2)
    texts = ["the of " * 60 + "x" * i for i in range(120)] + ["a", "the the"]
    seeds = row_seeds(list(range(len(texts))))
    found = sample_texts(vocab, texts, seeds, 4)
    floor = pieces._floor
    assert sum(np.isfinite(floor(np.zeros(2, int), np.zeros(1, int), np.zeros(3), np.zeros(4, int), np.arange(4.0), 4))) == 2
    monkeypatch.setattr(pieces, "_floor", lambda own, *rest: np.full(len(own), -np.inf))
    for with_, without in zip(found, sample_texts(vocab, texts, seeds, 4)):
        assert [r[0].tolist() for r in with_] == [r[0].tolist() for r in without]
        assert [r[1:] for r in with_] == [r[1:] for r in without]


def test_codes_are_spelled_and_pieces_decoded_for_a_slice_at_once():
    vocab = pieces.vocabulary(PATH)
    ids, ends = vocab.expand(np.array([5, -ord("😀"), 7, -ord("\n"), -ord("😀")]), np.array([0, 2, 2, 5]))
    smile = [vocab.byte_ids[b] for b in "😀".encode()]
    assert ids.tolist() == [5, *smile, 7, vocab.byte_ids[10], *smile]
    assert ends.tolist() == [0, 5, 5, 11]
    begin, data = vocab.decoded(ids)
    assert bytes(data[begin[1] : begin[5]]) == "😀".encode()
    assert [bytes(data[a:b]) for a, b in zip(begin, begin[1:])] == [vocab.text[i] for i in ids]
