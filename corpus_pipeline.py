"""The corpus pipeline: classify, drop near copies, cut repeats, mask personal data, pack."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curaspan.llm.common import table, written
from curaspan.llm.packing import pack
from curaspan.llm.pii import mask_pii
from curaspan.llm.quality_pu import keep_good
from curaspan.llm.simhash import drop_near_copies
from curaspan.llm.suffix import cut_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs, null_ids=True)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of 100 bytes or more stays where it comes first; no document goes."""
    return cut_repeats(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", drop_copies),
    ("suffix_array_dedup", cut_passages),
    ("personal_data", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

# The classifier, the fingerprints and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
