from __future__ import annotations

import random
import re

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from curaspan.llm.pii import pii_digest
from curaspan.llm.simhash import simhash_classes

from .test_packing import PATH, check_layout


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The result of every stage over the given tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_classifier_keeps_the_clean_and_drops_the_junk(spark, sf_dir, stages):
    kept = rows(stages[1])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    right = [(r["doc_id"] in kept) == (r["quality"] == 1) for r in labels]
    assert sum(right) > 0.95 * len(right)


def test_one_document_of_each_group_stays(stages):
    groups = {}
    for r in simhash_classes(stages[1]).collect():
        groups.setdefault(r["component_id"], set()).add(r["doc_id"])
    assert set(rows(stages[2])) == {min(g) for g in groups.values()}


def test_repeats_are_cut_and_no_document_lost(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    seen = set()
    for i in sorted(before):
        raw = before[i]["text"].encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        assert after[i]["text"] == rest.decode(errors="ignore")


def test_personal_data_is_masked(stages):
    before, after = rows(stages[3]), rows(stages[4])
    found = {r["doc_id"]: r for r in pii_digest(stages[3]).collect()}
    for i, row in before.items():
        if not found[i]["spans"]:
            assert after[i]["text"] == row["text"]
        else:
            assert re.search("<(EMAIL|IP|CARD|PHONE|IBAN|SSN|SECRET)>", after[i]["text"])
    assert not any(r["n_email"] for r in pii_digest(stages[4]).collect())


def test_every_token_is_packed(stages):
    plain = Tokenizer.from_file(PATH)
    packed = stages[5].collect()
    check_layout(packed)
    total = sum(
        len(plain.encode(r["text"], add_special_tokens=False).ids) + 1
        for r in stages[4].collect()
    )
    assert sum(r["length"] for r in packed) == total


def test_small_tables_with_nulls_and_more_columns(spark, tmp_path):
    rng = random.Random(1)
    words = ["the", "of", "river", "old", "bridge", "and", "night", "was"]
    texts = [None, "", "a"] + [" ".join(rng.choices(words, k=60)) + "." for _ in range(6)]
    made = [(i if i else None, t, "c0") for i, t in enumerate([*texts, texts[-1]])]
    docs = spark.createDataFrame(made, "doc_id long, text string, c1 string")
    labels = spark.createDataFrame([(3, 1), (4, None), (None, 1)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for source in (docs, docs.limit(0)):
        at = source
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, str(tmp_path))
        assert (at.count() > 0) == (source.count() > 0)
